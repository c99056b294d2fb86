"""Left lookup on a nullable key: equals the plain left join, even when a
lookup key equals a NULL row's stand-in."""

from __future__ import annotations

from shopstar.operators.lookup import left_lookup


def test_left_lookup_matches_plain_left_join(spark):
    rows = spark.createDataFrame(
        [(1, 1, "a"), (2, None, None), (3, None, "2"), (4, 3, "x")],
        "id long, k long, s string")
    ints = spark.createDataFrame([(-2, "collide"), (1, "one"), (3, "three")], "k long, v string")
    strs = spark.createDataFrame([("2", "collide"), ("a", "A"), ("3", "X")], "s string, w string")

    got = left_lookup(left_lookup(rows, "k", ints, "id", "v"), "s", strs, "id", "w")
    plain = rows.join(ints, "k", "left").join(strs, "s", "left")
    cols = ["id", "k", "s", "v", "w"]
    assert sorted(got.select(*cols).collect()) == sorted(plain.select(*cols).collect())
    assert {r.id: (r.v, r.w) for r in got.collect()} == {
        1: ("one", "A"), 2: (None, None), 3: (None, "collide"), 4: ("three", None)}
