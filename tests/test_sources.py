import json
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from pulsemill.sources import (
    array_rejects,
    consumed_files,
    dated_glob,
    documents_from_text,
    enabled_repositories,
    enrich,
    extraction_settings,
    files_of,
    line_rejects,
    merge_partitions,
    not_consumed,
    publish_table,
    raw_documents,
    read_landing,
    read_raw_arrays,
    read_raw_dates,
    read_raw_lines,
    read_table,
    rejected_files,
    replace_partitions,
    row_documents,
    stored,
    tables,
    write_landing,
)


def put(root, day, name, text):
    folder = root / "issues" / day
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


@pytest.fixture
def landing(tmp_path):
    put(tmp_path, "2024/01/02", "org_my_repo_issues_2024-01-02.json", '[\n {"id": 1},\n {"id": 2}\n]')
    put(tmp_path, "2024/01/31", "org_b_issues_2024-01-31.json", '[{"id":3}]')
    put(tmp_path, "2024/02/03", "org_b_issues_2024-02-03.json", '[{"id":4}]')
    put(tmp_path, "2024/02/03", "org_c_issues_2024-02-03.json", "[]")
    put(tmp_path, "2024/02/03", "org_d_issues_2024-02-03.json", "")
    put(tmp_path, "2024/02/04", "org_e_issues_2024-02-04.json", '[{"id":5},{"id":')
    return tmp_path


def ids(raw):
    return sorted(r[0] for r in raw.select(F.try_variant_get("raw_data", "$.id", "long")).collect())


def test_array_files(spark, landing):
    raw = read_raw_arrays(spark, str(landing))
    assert ids(raw) == [1, 2, 3, 4]
    assert raw.where("tie_breaker = 1").count() == 1
    assert raw.where("loaded_at is null or source_file is null").count() == 0


def test_malformed_files_are_named(spark, landing):
    found = [(r["source_file"], r["reason"]) for r in rejected_files(spark, str(landing)).collect()]
    assert len(found) == 1 and found[0][0].endswith("org_e_issues_2024-02-04.json") and found[0][1] == "truncated"


# Texts of files with the number of documents, or why there are none.
TEXTS = {
    '[{"a":1},{"a":2}]': 2, "[]": 0, " [ ] \n": 0, '[1,null,"s"]': 3, "": None, " \n\t": None,
    '[{"a":1},{"a":2}': "truncated", '[{"a":1},{"a":': "truncated", '[{"a":"]': "unparsable",
    '[{"a":1}] x': "trailing", '[{"a":1}],[{"a":2}]': "trailing", '[{"a":1}]]': "trailing", '[{"a":1}],[]': "trailing", '[1]} ,[]': "trailing",
    '{"a":1}': "not_an_array", "5": "not_an_array", '"x"': "not_an_array", "no json": "unparsable", '[{"a":1},{"a":2},]': "unparsable", '{"a":': "unparsable",
}


def test_every_file_is_accounted_for_once(spark):
    files = spark.createDataFrame([(t, "2024-01-01", f"f{i}") for i, t in enumerate(TEXTS)], "value string, loaded_at string, source_file string")
    documents = Counter(r["source_file"] for r in documents_from_text(files).collect())
    rejects = {r["source_file"]: r for r in array_rejects(files).collect()}
    for i, (text, outcome) in enumerate(TEXTS.items()):
        if isinstance(outcome, str):
            assert rejects[f"f{i}"]["reason"] == outcome and documents[f"f{i}"] == 0, text
            assert rejects[f"f{i}"]["n_chars"] == len(text) and rejects[f"f{i}"]["excerpt"] == text
        else:
            assert f"f{i}" not in rejects and documents[f"f{i}"] == (outcome or 0), text
    lines = spark.createDataFrame([('{"a":1}', "t", "f"), ("{bad", "t", "f"), ("", "t", "f")], "value string, loaded_at string, source_file string")
    assert [(r["reason"], r["excerpt"]) for r in line_rejects(lines).collect()] == [("unparsable", "{bad")]


def test_dated_scan(spark, landing):
    raw = read_raw_dates(spark, str(landing), "issues", date(2024, 1, 1), date(2024, 1, 31))
    assert ids(raw) == [1, 2, 3]
    assert {(r["path_repository"], r["path_date"]) for r in raw.collect()} == {
        ("org_my_repo", date(2024, 1, 2)),
        ("org_b", date(2024, 1, 31)),
    }


def test_whole_months_become_one_pattern():
    glob = dated_glob("r", "issues", date(2024, 1, 31), date(2024, 3, 1))
    assert glob == "r/issues/{2024/01/31,2024/02/*,2024/03/01}"


def test_landing_is_idempotent(spark, tmp_path):
    root = str(tmp_path / "landing")

    def land(rows):
        frame = spark.createDataFrame(rows, "id long, repo string, day string")
        enriched = enrich(frame, "issues", F.col("repo"), F.col("day"), "2024-01-03 00:00:00")
        write_landing(row_documents(enriched), root, "issues")

    first = [(1, "o/a_b", "2024-01-01"), (2, "o/a_b", "2024-01-02"), (3, "o/c", "2024-01-02")]
    land(first)
    land(first)
    assert ids(read_raw_lines(spark, root)) == [1, 2, 3]
    land([(9, "o/a_b", "2024-01-02")])
    assert ids(read_landing(spark, root, "issues")) == [1, 3, 9]
    land([])
    assert ids(read_landing(spark, root, "issues", date(2024, 1, 2), date(2024, 1, 2))) == [3, 9]
    row = read_landing(spark, root, "issues").where("path_repository = 'o/c'").first()
    doc = json.loads(row["raw_data"].toJson())
    assert doc["source_repository"] == "o/c"
    assert doc["source_file"] == "issues/2024/01/02/o_c_issues_2024-01-02.json"


def test_repository_named_by_digits(spark, tmp_path):
    root = str(tmp_path / "landing")
    frame = spark.createDataFrame([(1, "007", "2024-01-01")], "id long, repo string, day string")
    enriched = enrich(frame, "issues", F.col("repo"), F.col("day"), "2024-01-03 00:00:00")
    write_landing(row_documents(enriched), root, "issues")
    row = read_landing(spark, root, "issues").first()
    assert (row["path_repository"], row["path_date"]) == ("007", date(2024, 1, 1))


def test_metadata_is_added_to_raw_documents(spark, raw):
    frame = raw(
        ('{"id":1,"t":"x,}"}', "2024-01-01", "f", 0),
        ("{}", "2024-01-01", "f", 1),
        ('{"id":3,"extraction_date":"2020-01-01","extracted_at":null}', "2024-01-01", "f", 2),
    )
    out = raw_documents(frame, "issues", F.lit("o/r"), F.lit("2024-01-05"), "2024-01-05 01:02:03")
    docs = [json.loads(r["document"]) for r in out.collect()]
    assert docs[0]["t"] == "x,}" and docs[0]["extracted_at"] == "2024-01-05T01:02:03Z"
    assert docs[1]["source_repository"] == "o/r"
    assert docs[2]["extraction_date"] == "2020-01-01" and docs[2]["extracted_at"] is None
    assert out.where(F.try_parse_json("document").isNull()).count() == 0


def test_config(spark, tmp_path):
    config = {
        "repositories": [
            {"owner": "a", "repo": "x", "enabled": True},
            {"owner": "a", "repo": "y"},
            {"owner": "b", "repo": "z", "enabled": False},
            {"owner": "b", "repo": "w", "enabled": None},
        ],
        "extraction_config": {"lookback_days": 7, "max_issues_per_repo": 500},
    }
    path = tmp_path / "repositories.json"
    path.write_text(json.dumps(config, indent=2))
    names = {r["full_name"] for r in enabled_repositories(spark, str(path)).collect()}
    assert names == {"a/x", "a/y", "b/w"}
    settings = extraction_settings(spark, str(path)).first()
    assert (settings["lookback_days"], settings["max_issues_per_repo"]) == (7, 500)


def test_names_and_origins_stay_apart(spark, tmp_path):
    root = str(tmp_path / "landing")
    names = ["a_b/c", "a/b_c", "a/b%2Fc", "ä b/ü+=c", "x/.."]

    def land(ids_and_names, origin):
        frame = spark.createDataFrame([(i, n, "2024-01-02") for i, n in ids_and_names], "id long, repo string, day string")
        enriched = enrich(frame, "issues", F.col("repo"), F.col("day"), "2024-01-03 00:00:00")
        write_landing(row_documents(enriched), root, "issues", origin)

    land(list(enumerate(names)), "run-1")
    land([(100, "a_b/c")], "extract")
    land([(101, "a_b/c")], "extract")
    got = read_landing(spark, root, "issues")
    assert sorted((r["path_origin"], r["path_repository"]) for r in got.collect()) == sorted([("extract", "a_b/c"), *(("run-1", n) for n in names)])
    assert ids(got) == [0, 1, 2, 3, 4, 101]
    assert ids(read_landing(spark, root, "issues", origin="extract")) == [101]


def data_files(folder):
    return sorted(str(f) for f in folder.rglob("*.parquet") if "log" not in f.parts)


def test_merge_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, i % 5, "old") for i in range(50)]
    publish_table(spark.createDataFrame(rows, "id long, p long, v string"), path, ["p"])
    first = set(data_files(tmp_path / "t"))
    delta = spark.createDataFrame([(5, 0, "new"), (100, 0, "new")], "id long, p long, v string")
    for _ in range(2):
        merge_partitions(spark, path, delta, ["id"], "p")
        table = read_table(spark, path)
        assert table.count() == 51 and table.where("v = 'new'").count() == 2
    # Nothing that was written is changed, and only the touched partition is written again.
    now = set(data_files(tmp_path / "t"))
    assert first < now and all("/p=0/" in f for f in now - first)


def test_new_columns_and_other_types(spark, tmp_path):
    path = str(tmp_path / "t")
    publish_table(spark.createDataFrame([(1, 0), (2, 1)], "id long, p long"), path, ["p"])
    merge_partitions(spark, path, spark.createDataFrame([(2, 1, "x"), (3, 1, "y")], "id long, p long, v string"), ["id"], "p")
    assert sorted(map(tuple, read_table(spark, path).select("id", "p", "v").collect())) == [(1, 0, None), (2, 1, "x"), (3, 1, "y")]
    with pytest.raises(ValueError, match="column v is string"):
        merge_partitions(spark, path, spark.createDataFrame([(2, 1, 5)], "id long, p long, v long"), ["id"], "p")
    replace_partitions(spark.createDataFrame([], "id long, p long"), path, "p", [1])
    assert [tuple(r) for r in read_table(spark, path).collect()] == [(1, 0, None)]
    replace_partitions(spark.createDataFrame([], "id long, p long"), path, "p", [0])
    assert read_table(spark, path).collect() == [] and read_table(spark, path).columns == ["id", "p", "v"]


def test_a_lost_write_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    assert stored(spark, path) is None
    for partition in (None, ["p"]):
        publish_table(spark.range(3).withColumn("p", F.lit(1)), path, partition)
        reader = read_table(spark, path)
        with monkeypatch.context() as lost:
            lost.setattr(tables, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                publish_table(spark.range(9).withColumn("p", F.lit(2)), path, partition)
        assert read_table(spark, path).count() == 3
        # The next write takes the number of the lost one; who read before goes on reading.
        publish_table(spark.range(5).withColumn("p", F.lit(2)), path, partition)
        assert read_table(spark, path).count() == 5 and reader.count() == 3


def test_consumed_files_are_committed_with_the_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")

    def rows(*files):
        frame = spark.createDataFrame([(i, 0, f, at) for i, (f, at) in enumerate(files)], "id long, p long, source_file string, at string")
        return frame.withColumn("loaded_at", F.col("at").cast("timestamp")).drop("at")

    one, same_time, older, rewritten = ("a", "2024-01-02"), ("b", "2024-01-02"), ("c", "2024-01-01"), ("a", "2024-01-03")
    assert consumed_files(spark, path).count() == 0
    publish_table(rows(one), path, ["p"], files_of({"issues": rows(one)}))
    every = rows(one, same_time, older, rewritten, (None, "2024-01-02"))

    def fresh(source="issues"):
        return sorted(str(r["source_file"]) for r in not_consumed(every, consumed_files(spark, path), source).collect())

    assert fresh() == ["None", "a", "b", "c"] and len(fresh("comments")) == 5
    with monkeypatch.context() as lost:
        lost.setattr(tables, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            replace_partitions(every, path, "p", [0], files_of({"issues": every}))
    assert fresh() == ["None", "a", "b", "c"]
    replace_partitions(every, path, "p", [0], files_of({"issues": every}))
    assert fresh() == []
    publish_table(rows(one), path, ["p"], files_of({"issues": rows(one)}))
    assert fresh() == ["None", "a", "b", "c"]


def test_merge_handles_the_null_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "id long, v string, p long"
    publish_table(spark.createDataFrame([(1, "old", None), (2, "old", 1)], schema), path, ["p"])
    delta = spark.createDataFrame([(1, "new", None), (3, "new", None)], schema)
    merge_partitions(spark, path, delta, ["id"], "p")
    assert sorted(map(tuple, read_table(spark, path).collect())) == [
        (1, "new", None),
        (2, "old", 1),
        (3, "new", None),
    ]
