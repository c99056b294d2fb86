"""Files of records that span lines: the split reader against the parsers'
own multi-line mode, with splits of a few dozen bytes."""

from __future__ import annotations

import csv
import json
import random

import pytest

from shopstar.sources.io import read_csv, read_documents
from shopstar.sources.schemas import PRODUCT_DOCUMENT, SOURCE
from shopstar.sources.splits import CSV, MalformedFile, _chunks

ADDRESS = SOURCE["customer_addresses"]


@pytest.fixture()
def splits(spark):
    """Splits of the given number of bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}

    def set_to(n):
        for k in keys:
            spark.conf.set(k, str(n))

    yield set_to
    for k, v in before.items():
        spark.conf.set(k, v)


def plain_csv(spark, path, schema):
    return spark.read.schema(schema).options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
                                             ignoreTrailingWhiteSpace=False, mode="FAILFAST", multiLine=True,
                                             enforceSchema=False, nullValue="\0").csv(path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def parsed(df):
    """Documents with their open attributes as values: as text they may differ in blanks."""
    return sorted((tuple(json.loads(v) if c == "attributes" and v else v for c, v in zip(df.columns, r))
                   for r in df.collect()), key=repr)


def address_file(path, n, seed, end="\n"):
    rng = random.Random(seed)
    values = ["", "plain", "two\nlines", "a,b", 'he said "hi"', '"', '""', "\n\n\n", " lead", "trail ", "é\n日本\n", "x" * 90,
              '\n"\n"', ",", "\n,\n1,2,billing"]
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(ADDRESS.names)
        w.writerows([k, k % 7, *(rng.choice(values) for _ in range(6))] for k in range(n))


@pytest.mark.parametrize("size", [150, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_in_splits_equals_the_multi_line_reader(spark, tmp_path, splits, size, end):
    for k in range(2):
        address_file(tmp_path / f"{k}.csv", 30, k, end)
    want = rows(plain_csv(spark, str(tmp_path), ADDRESS))
    splits(size)
    got = read_csv(spark, str(tmp_path), ADDRESS)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in ADDRESS]
    assert rows(got) == want and len(want) == 60
    if size == 150:
        assert _chunks(spark, str(tmp_path), CSV).rdd.getNumPartitions() > 20  # one file, many tasks


def test_a_value_longer_than_several_splits(spark, tmp_path, splits):
    path = tmp_path / "a.csv"
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerow(ADDRESS.names)
        w.writerows([[1, 1, "a", "long\n" * 200, "", "", "", ""], [2, 1, "b", "", "", "", "", "no end of line\n"]])
    want = rows(plain_csv(spark, str(path), ADDRESS))
    splits(100)
    assert rows(read_csv(spark, str(path), ADDRESS)) == want and len(want) == 2


def test_csv_faults(spark, tmp_path, splits):
    splits(50)
    head = ",".join(ADDRESS.names) + "\n"
    path = tmp_path / "a.csv"
    path.write_text(head + '1,1,a,"open,b,c,d,e\n2,1,a,b,c,d,e,f\n')
    with pytest.raises(MalformedFile):
        read_csv(spark, str(path), ADDRESS)
    for text in (head + "1,1,a,b,c,d,e\n", head + "1,1,a,b,c,d,e,f,g\n", head.replace("city", "town") + "1,1,a,b,c,d,e,f\n",
                 head[:-2] + "\n1,1,a,b,c,d,e,f\n"):
        path.write_text(text)
        with pytest.raises(Exception):
            read_csv(spark, str(path), ADDRESS).collect()
    path.write_text(head)
    assert read_csv(spark, str(path), ADDRESS).count() == 0
    path.write_text('"' + '","'.join(ADDRESS.names) + '"\n\n1,1,a,b,c,d,e,f')
    assert read_csv(spark, str(path), ADDRESS).count() == 1


def documents(n, seed):
    rng = random.Random(seed)
    texts = ["", "plain", "}", "{", '"', '\\"', "\\", "\\\\", "]}", "},{", 'a"b}c', "two\nlines", "é}日本", "[[[", ", {"]
    return [{"_id": {"$oid": str(k)}, "product_id": f"P{k}", "name": rng.choice(texts),
             "brand": {"name": rng.choice(texts)}, "category": {"name": rng.choice(texts), "parent": None},
             "pricing": {"price": k + 0.5}, "attributes": {rng.choice(texts) or "k": rng.choice(texts), "n": [1, {"m": 2}]},
             "variants": [{"sku": rng.choice(texts), "stock": j} for j in range(k % 3)],
             "tags": [rng.choice(texts) for _ in range(k % 4)]} for k in range(n)]


@pytest.mark.parametrize("size", [120, 1 << 20])
@pytest.mark.parametrize("style", [{}, {"indent": 1}, {"separators": (",", ":")}])
def test_json_array_in_splits_equals_the_multi_line_reader(spark, tmp_path, splits, size, style):
    for k in range(2):
        (tmp_path / f"{k}.json").write_text(json.dumps(documents(9, k), ensure_ascii=k == 0, **style), encoding="utf-8")
    (tmp_path / "none.json").write_text(" [ ]\n")
    want = parsed(spark.read.schema(PRODUCT_DOCUMENT).options(multiLine=True, mode="FAILFAST").json(str(tmp_path)))
    splits(size)
    assert parsed(read_documents(spark, str(tmp_path), multi_line=True)) == want and len(want) == 18


@pytest.mark.parametrize("text", ['[{"product_id": "a"}', '[{"product_id": "a"', '[{"product_id": "a"}, {"b": "]', "[1, 2]",
                                  '[{"product_id": "a"} {"product_id": "b"}]', '[{"product_id": "a"}, 7]',
                                  '[{"product_id": "a"}}]', '{"product_id": "a"}', '[{"product_id": }]',
                                  '[[{"product_id": "a"}]]', '[{"product_id": "a"}]]'])
def test_malformed_arrays_are_errors(spark, tmp_path, splits, text):
    splits(16)
    (tmp_path / "p.json").write_text(text)
    with pytest.raises(Exception):
        read_documents(spark, str(tmp_path / "p.json"), multi_line=True).collect()
