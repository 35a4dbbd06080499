import json

from mercato.plans import jobs
from mercato.sources import readers

GOOD = {"user_id": "u1", "geo_data": {"city": "A", "state": "B", "country": "C"}, "registration_date": "2024-01-01", "last_active": None}


def write(path, lines):
    path.write_text("\n".join(lines) + "\n")


def read(spark, folder, name="users"):
    good, rejected = readers.read_checked(spark, str(folder), name)
    return good.collect(), sorted((r.reason, r.record, r.file.rsplit("/", 1)[1]) for r in rejected.collect())


def test_every_line_is_good_or_rejected(spark, tmp_path):
    bad = ['{"user_id": "u2", "geo_data"', "not json", '{"user_id": "u3", "geo_data": 7}', "[7]x", '"text"', "5",
           '{"unknown": 1}', "{}", '{"user_id": null}']
    lines = [json.dumps(GOOD | {"user_id": f"u{i}"}) for i in range(20)]
    write(tmp_path / "users.json", lines[:10] + bad + lines[10:])
    good, rejected = read(spark, tmp_path)
    assert len(good) + len(rejected) == len(lines) + len(bad)
    assert sorted(r.user_id for r in good) == sorted(f"u{i}" for i in range(20))
    assert all(any(v is not None for v in r) for r in good)
    assert {r[0] for r in rejected} == {"malformed", "type", "empty"} and {r[2] for r in rejected} == {"users.json"}
    reasons = {r[1]: r[0] for r in rejected}
    assert reasons["not json"] == "malformed" and reasons[bad[0]] == "malformed" and reasons[bad[2]] == "type"
    assert [r[0] for r in rejected].count("empty") == 3


def test_a_broken_line_no_longer_passes_as_nulls(spark, tmp_path):
    write(tmp_path / "users.json", [json.dumps(GOOD), "{broken", json.dumps(GOOD)])
    assert [r.user_id for r in readers.read_raw(spark, str(tmp_path), "users").collect()] == ["u1", None, "u1"]
    good, rejected = read(spark, tmp_path)
    assert [r.user_id for r in good] == ["u1", "u1"] and rejected == [("malformed", "{broken", "users.json")]


def test_arrays_globs_and_empty_files(spark, tmp_path):
    (tmp_path / "sessions_1.json").write_text(json.dumps([{"session_id": "a"}, {"session_id": "b", "duration_seconds": 5}]))
    (tmp_path / "sessions_2.json").write_text("")
    (tmp_path / "sessions_3.json").write_text('[{"session_id": "c"}, {"session_id"')
    good, rejected = read(spark, tmp_path, "sessions")
    assert sorted(r.session_id for r in good) == ["a", "b"]
    assert [(r[0], r[2]) for r in rejected] == [("malformed", "sessions_3.json")]


def test_job_counts_and_lands_both(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for name, file in readers.RAW_FILES.items():
        key = {"users": "user_id", "products": "product_id", "categories": "category_id", "transactions": "transaction_id",
               "sessions": "session_id"}[name]
        write(raw / file.replace("*", "1"), [json.dumps({key: "x"}), "{", "{}"])
    counts = jobs.check_raw(spark, str(raw), str(tmp_path / "out"))
    assert counts == {name: {"good": 1, "malformed": 1, "empty": 1} for name in readers.RAW_FILES}
    kept = spark.read.parquet(str(tmp_path / "out" / "rejected" / "users"))
    assert kept.columns == ["file", "reason", "record"] and kept.count() == 2
