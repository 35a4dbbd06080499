import gzip
import hashlib
import json
import os
import random

import pytest

from mercato.llm import warc as A
from mercato.llm.store import new_folder
from tests.conftest import SF_CHECK


def brute(rows):
    first = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and p is not None:
            first[b] = min(p, first.get(b, p))
    out = []
    for p, _, h in rows:
        b = (h or "").encode()
        f = first.get(b)
        again = f is not None and f != p
        out.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in A.digest(df).collect()), key=str)


def test_driver_table(spark):
    pages = spark.read.parquet(f"{SF_CHECK}/pages.parquet")
    assert got(A.round_trip(pages)) == brute([(r.page_id, r.url, r.html) for r in pages.collect()])


def some_pages(n=400):
    rnd = random.Random(6)
    texts = ["é" * 49, "é" * 50, "x" * 99, "x" * 100, "y\r\n\r\nWARC/1.1\r\n" * 20, "", "hot " * 100]
    rows = [(i, f"http://h/{i}", "hot " * 100 if i % 3 == 0 else rnd.choice(texts + [str(rnd.random()) * 40])) for i in range(n)]
    rnd.shuffle(rows)
    return rows + [(n, None, None), (n + 1, "http://a b\r\nX: y/é", "z" * 200), (None, "u", "z" * 200), (None, "u", "only null" * 20),
                   (3, "again", "hot " * 100), (0, "again", "hot " * 100), (n + 2, "long", "w" * 3_000_000)]


def files(folder):
    path = folder.removeprefix("file://").removeprefix("file:")
    return {f: open(f"{path}/{f}", "rb").read() for f in sorted(os.listdir(path)) if f.endswith(".warc.gz")}, path


def test_rolled_files_are_the_same_each_time(spark):
    rows = some_pages()
    schema = "page_id long, url string, html string, digest int"
    df = spark.createDataFrame([(*r, 1) for r in rows], schema)
    seen = []
    for parts in (2, 7):
        folder = A.write_warc(df.repartition(parts), new_folder(spark, "warc-test"), shard_bytes=20_000, file_bytes=4_000)
        assert got(A.read_warc(spark, folder)) == brute(rows)
        found, path = files(folder)
        seen.append(found)
        assert not os.path.exists(f"{path}/_attempts") and os.path.exists(f"{path}/_manifest/_SUCCESS")
        listed = [json.loads(x) for f in os.listdir(f"{path}/_manifest") if f.startswith("part") for x in open(f"{path}/_manifest/{f}")]
        assert {m["file"]: m["sha256"] for m in listed} == {f: hashlib.sha256(b).hexdigest() for f, b in found.items()}
        assert sum(m["records"] for m in listed) == len(rows)
        assert all(m["bytes"] <= 4_000 or m["records"] == 1 for m in listed)
        order = [h["WARC-Page-ID"] for f in found for h, _ in A.parse(gzip.decompress(found[f])) if "WARC-Page-ID" in h]
        assert list(map(int, order)) == sorted(map(int, order))
    assert seen[0] == seen[1] and len(seen[0]) > 5


def test_payloads_survive(spark):
    rows = some_pages(50)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    back = {r.page_id: bytes(r.payload).decode() for r in A.round_trip(df).where("record_type = 'response'").collect()}
    text = {p: h or "" for p, _, h in rows}
    assert all(back[p] == text[p] for p in back if p is not None)


def test_damage_is_noticed(spark):
    df = spark.createDataFrame(some_pages(30), "page_id long, url string, html string")
    folder = A.write_warc(df, new_folder(spark, "warc-test"))
    found, path = files(folder)
    name = next(iter(found))
    open(f"{path}/stray.warc.gz", "wb").write(b"not listed")
    assert A.read_warc(spark, folder).count() == 37
    open(f"{path}/{name}", "wb").write(found[name][:-20])
    with pytest.raises(Exception, match="differs from the manifest"):
        A.read_warc(spark, folder).count()
    os.truncate(f"{path}/{name}", 0)
    spark.read.schema(A._MANIFEST).json(f"{folder}/_manifest").selectExpr(
        "concat('gone-', file) AS file", "bytes", "records", "sha256").write.mode("append").json(f"{folder}/_manifest")
    with pytest.raises(ValueError, match="missing"):
        A.read_warc(spark, folder)


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert A.round_trip(df).count() == 0


def test_pages_without_an_id_or_of_one_id_fill_several_shards(spark):
    rows = [(None, f"http://n/{i % 97}", f"{i} " * 60) for i in range(300)] + [(7, f"http://s/{i % 5}", f"x{i % 9} " * 80) for i in range(300)]
    rows += [(i, None, "hot " * 90) for i in range(50)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    seen = []
    for parts in (1, 6):
        folder = A.write_warc(df.repartition(parts), new_folder(spark, "warc-test"), shard_bytes=4_000)
        assert got(A.read_warc(spark, folder)) == brute(rows)
        found, _ = files(folder)
        seen.append(found)
    assert seen[0] == seen[1]
    assert len({f.split("-")[1] for f in seen[0]}) > 20
    # the first records are those without an id
    of = {f: [h.get("WARC-Page-ID") for h, _ in A.parse(gzip.decompress(b)) if h["WARC-Type"] != "warcinfo"] for f, b in seen[0].items()}
    assert sum(set(ids) == {None} for ids in of.values()) > 5 and sum(set(ids) == {"7"} for ids in of.values()) > 5
