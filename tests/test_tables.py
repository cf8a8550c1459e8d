"""Quality checks, history, export, appends, lookups."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio_sync import schemas
from folio_sync.operators import quality, report, runs
from folio_sync.plans import publish
from folio_sync.sources import corpus, export, load

TS = dt.datetime(2024, 1, 1, 10)


def test_schema_messages():
    found = dict(schemas.TABLES)
    quality.validate_schemas(found)
    with pytest.raises(quality.SchemaError, match="no table 'articles_content'"):
        quality.validate_schemas(found | {"articles_content": None})
    less = T.StructType([f for f in schemas.METADATA if f.name != "is_retracted"])
    with pytest.raises(quality.SchemaError, match="'articles_metadata' lacks the column 'is_retracted'"):
        quality.validate_schemas(found | {"articles_metadata": less})
    other = T.StructType([T.StructField(f.name, T.StringType()) for f in schemas.METADATA])
    with pytest.raises(quality.SchemaError, match="pmid"):
        quality.validate_schemas(found | {"articles_metadata": other})


def test_quality_checks(spark):
    df = spark.createDataFrame([("a" * 21, None), (None, "d"), ("b", "d" * 300), ("b", "d")], "pmcid string, doi string")
    assert quality.table_violations(df, "articles_metadata").first().asDict() == {
        "n_rows": 4, "pmcid_missing": 1, "pmcid_too_long": 1, "doi_too_long": 1,
    }
    with pytest.raises(quality.QualityError, match="pmcid_too_long"):
        quality.require_clean(df, "articles_metadata")
    with pytest.raises(quality.QualityError, match="'b'"):
        quality.require_unique(df, ["pmcid"], "x")
    parents = spark.createDataFrame([("b",)], "pmcid string")
    assert quality.orphans(df, parents, "pmcid").count() == 2


def test_history_of_runs(tmp_path, spark):
    root = str(tmp_path)
    corpus.initialize(spark, root)
    assert corpus.read_history(spark, root).isEmpty()
    full = corpus.start_run(spark, root, "FULL", TS)
    corpus.end_run(spark, root, full, "SUCCESS", TS, {"a": 1}, "first")
    corpus.end_run(spark, root, full, "SUCCESS", TS + dt.timedelta(hours=1))  # keeps file and metrics
    delta = corpus.start_run(spark, root, "DELTA", TS)
    corpus.update_run_state(spark, root, delta, "p1")
    corpus.update_run_state(spark, root, delta, "p2")
    corpus.end_run(spark, root, delta, "FAILED", TS, {})
    history = corpus.read_history(spark, root)
    assert history.columns == [f.name for f in schemas.HISTORY]
    got = {r.run_id: r for r in history.collect()}
    assert (full, delta) == (1, 2) and len(got) == 2
    assert got[1].last_file_processed == "first" and got[1].metrics == {"a": 1} and got[1].end_time.hour == 11
    assert (got[2].status, got[2].last_file_processed, got[2].metrics) == ("FAILED", "p2", None)
    assert history.select(runs.metric("a")).where("run_id = 1").first()[0] == 1
    assert runs.last_successful_run(history).isEmpty()
    assert runs.watermark(history).first().run_id == 1


def test_last_successful_run_and_watermark(spark):
    history = spark.createDataFrame([
        (1, "FULL", "SUCCESS", 5), (2, "DELTA", "SUCCESS", 3), (3, "DELTA", "FAILED", 9), (4, "DELTA", "SUCCESS", 4), (5, "DELTA", "RUNNING", None),
    ], "run_id bigint, run_type string, status string, end_time int")
    assert runs.last_successful_run(history).first().run_id == 4
    assert runs.last_successful_run(history, "FULL").first().run_id == 1
    assert runs.last_successful_run(history, "TEST").first() is None
    assert runs.watermark(history).first().run_id == 4
    assert runs.watermark(history.where("status = 'FAILED'")).first() is None


def metadata_row(pmcid, **values):
    row = dict(
        pmcid=pmcid, pmid=7, doi="10.1/x", title="T", abstract_text=None, publication_date=dt.date(2024, 1, 2),
        journal_info=("J", None, 'P "q"'), contributors=[("A", None, "1")], license_info=None, is_retracted=False,
        source_last_updated=TS, sync_timestamp=TS.replace(microsecond=5),
    ) | values
    return tuple(row[f.name] for f in schemas.METADATA)


def test_export_format(spark):
    df = spark.createDataFrame([metadata_row("P1", title="a\tb\\c\nd"), metadata_row("P2", pmid=None, contributors=[], is_retracted=True)], schemas.METADATA)
    lines = sorted(r.value for r in export.delimited_lines(df).collect())
    assert lines[0].split("\t") == [
        "P1", "7", "10.1/x", "a\\tb\\\\c\\nd", "\\N", "2024-01-02", '{"name":"J","issn":null,"publisher":"P \\\\"q\\\\""}',
        '[{"name":"A","affiliation":null,"orcid":"1"}]', "\\N", "False", "2024-01-01 10:00:00+00:00", "2024-01-01 10:00:00.000005+00:00",
    ]
    assert lines[1].split("\t")[:2] == ["P2", "\\N"] and "\t[]\t" in lines[1] and "\tTrue\t" in lines[1]
    assert [r.value for r in export.delimited_lines(df, ["pmid", "pmcid"]).collect()] == ["7\tP1", "\\N\tP2"]


def test_delimited_text_comes_back(tmp_path, spark):
    odd = ["\\N", "\\", "\\t", "a\\\tb\n\\\\n", "\\\\N", "", "tab\tend\t", None]
    df = spark.createDataFrame(
        [metadata_row(f"P{i}", abstract_text=t, license_info=(t, None), pmid=None if i else 1, is_retracted=bool(i % 2),
                      contributors=[(t or "x", None, "1")]) for i, t in enumerate(odd)], schemas.METADATA)
    export.write_delimited(df, str(tmp_path / "d"))
    back = export.read_delimited(spark, str(tmp_path / "d"), schemas.METADATA)
    assert sorted(back.collect(), key=lambda r: r.pmcid) == sorted(df.collect(), key=lambda r: r.pmcid)


def test_batches_of_a_staged_load(tmp_path, spark):
    rows = spark.createDataFrame([("a", 1)], "k string, n int")
    rows.write.parquet(str(tmp_path / "1"))
    rows.where("false").write.parquet(str(tmp_path / "2"))
    rows.write.parquet(str(tmp_path / "3"))
    paths = [str(tmp_path / n) for n in ("1", "2", "3", "absent")]
    assert load.read_batches(spark, paths, rows.schema).count() == 2
    assert load.read_batches(spark, paths[3:], rows.schema).isEmpty()


def test_articles_from_any_source(tmp_path, spark):
    root = str(tmp_path)
    corpus.initialize(spark, root)
    run = corpus.start_run(spark, root, "TEST", TS)

    def pair(*items):
        return (
            spark.createDataFrame([metadata_row(k, title=t, source_last_updated=c) for k, t, c in items], schemas.METADATA),
            spark.createDataFrame([(k, "<x/>", t) for k, t, _ in items], schemas.CONTENT),
        )

    def state():
        texts = {r.pmcid: r.body_text for r in corpus.read_content(spark, root).collect()}
        return {r.pmcid: (r.title, texts.get(r.pmcid)) for r in corpus.read_metadata(spark, root).collect()}

    late = TS + dt.timedelta(days=1)
    publish.append_articles(spark, root, run, *pair(("a", "1", TS), ("b", "1", None)))
    publish.append_articles(spark, root, run, *pair(("c", "1", late)))
    with pytest.raises(quality.QualityError, match="already present"):
        publish.append_articles(spark, root, run, *pair(("a", "2", late)))
    with pytest.raises(quality.QualityError, match="Duplicate"):
        publish.upsert_articles(spark, root, run, *pair(("d", "2", late), ("d", "3", late)))
    with pytest.raises(quality.QualityError, match="without metadata"):
        publish.upsert_articles(spark, root, run, pair(("d", "2", late))[0], pair(("e", "2", late))[1])
    publish.upsert_articles(spark, root, run, *pair(("a", "2", late), ("b", "2", None), ("c", "2", TS), ("d", "2", None)), last_file="f1")
    assert state() == {"a": ("2", "2"), "b": ("2", "2"), "c": ("1", "2"), "d": ("2", "2")}
    assert corpus.read_history(spark, root).first().last_file_processed == "f1"
    publish.upsert_articles(spark, root, run, *pair(("c", "3", TS), ("d", "3", TS)), guard_content=True)
    assert state() == {"a": ("2", "2"), "b": ("2", "2"), "c": ("1", "2"), "d": ("3", "3")}
    assert quality.check_quality(corpus.read_metadata(spark, root), corpus.read_content(spark, root)).isEmpty()
    publish.replace_articles(spark, root, run, *pair(("z", "1", None)))
    assert state() == {"z": ("1", "1")}


def test_append_and_union(tmp_path, spark):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    rows.write.parquet(path)
    target = spark.read.parquet(path)
    more = spark.createDataFrame([(3, "c")], "n int, k string")
    load.append_rows(more, target, path, key="k")
    assert spark.read.parquet(path).count() == 3
    for bad in (rows, load.staging_union([more, more])):
        with pytest.raises(quality.QualityError):
            load.append_rows(bad, spark.read.parquet(path), path, key="k")
    assert spark.read.parquet(path).count() == 3
    load.append_rows(rows, target, path)
    assert spark.read.parquet(path).count() == 5
    assert load.staging_union([rows, more, more]).count() == 4


def test_versions_are_invisible_until_committed(tmp_path, spark):
    root = str(tmp_path)
    corpus.initialize(spark, root)
    corpus.validate(spark, root)
    run = corpus.start_run(spark, root, "FULL", TS)
    first = spark.createDataFrame([metadata_row("P1"), metadata_row("P2")], schemas.METADATA)
    corpus.write_version(spark, root, corpus.METADATA, 1, first)
    corpus.write_version(spark, root, corpus.CONTENT, 1, schemas.empty(spark, schemas.CONTENT))
    assert corpus.read_metadata(spark, root).isEmpty()
    corpus.commit(spark, root, run, 1, "replace")
    assert corpus.read_metadata(spark, root).count() == 2
    old = corpus.read_table(spark, root, corpus.METADATA).where("pmcid = 'P1'")
    second = spark.createDataFrame([metadata_row("P1", title="new"), metadata_row("P3")], schemas.METADATA)
    corpus.write_version(spark, root, corpus.METADATA, 2, second, old)
    corpus.write_version(spark, root, corpus.CONTENT, 2, schemas.empty(spark, schemas.CONTENT))
    assert corpus.read_metadata(spark, root).count() == 2
    corpus.commit(spark, root, run, 2, last_file="f")
    assert {r.pmcid: r.title for r in corpus.read_metadata(spark, root).collect()} == {"P1": "new", "P2": "T", "P3": "T"}
    assert corpus.read_history(spark, root).first().last_file_processed == "f"
    with pytest.raises(corpus.ConcurrentWrite):  # computed before version 2 was published
        corpus.commit(spark, root, run, corpus.next_version(), based_on=[1])
    assert corpus.live_versions(spark, root) == [1, 2]
    found = report.lookup(corpus.read_metadata(spark, root), pmid=7, doi="10.1/x", published_from=dt.date(2024, 1, 2), published_until=dt.date(2024, 1, 2))
    assert found.count() == 3
    assert report.lookup(corpus.read_metadata(spark, root), published_from=dt.date(2024, 1, 3)).isEmpty()


def test_lookup_conditions_reach_the_scan(tmp_path, spark):
    path = str(tmp_path / "m")
    spark.createDataFrame([metadata_row("P1")], schemas.METADATA).write.parquet(path)
    found = report.lookup(spark.read.parquet(path), pmid=7, published_from=dt.date(2024, 1, 1)).select("pmcid")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(pmid,7)" in plan and "GreaterThanOrEqual(publication_da" in plan
    assert "title" not in plan.split("ReadSchema")[1]


def test_corpus_report(spark):
    metadata = spark.createDataFrame([metadata_row("P1"), metadata_row("P2", pmid=None, is_retracted=True)], schemas.METADATA)
    content = spark.createDataFrame([("P1", "x", "y"), ("P2", "x", None)], schemas.CONTENT)
    row = report.corpus_report(metadata, content).first().asDict()
    assert row == dict(n_articles=2, n_retracted=1, n_with_pmid=1, n_with_doi=2, n_with_source_time=2, n_contributors=2, n_contents=2, n_with_body=1)


def test_buckets_serve_merges_and_reads(tmp_path, spark):
    """Without any broadcast: texts are read without an exchange, merges scan the buckets of their keys alone."""
    root = str(tmp_path)
    corpus.initialize(spark, root, buckets=16)
    run = corpus.start_run(spark, root, "TEST", TS)

    def pair(numbers, title):
        rows = [metadata_row(f"P{i}", title=title, source_last_updated=TS + dt.timedelta(days=len(title))) for i in numbers]
        texts = [(f"P{i}", "<x/>", title) for i in numbers]
        return spark.createDataFrame(rows, schemas.METADATA), spark.createDataFrame(texts, schemas.CONTENT)

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        publish.replace_articles(spark, root, run, *pair(range(200), "a"))
        publish.upsert_articles(spark, root, run, *pair((3, 7, 500), "bb"))
        content = corpus.read_content(spark, root)
        plan = content._jdf.queryExecution().executedPlan().toString()
        assert "raw_jats_xml" in plan and "Exchange" not in plan and "ShuffledHashJoin" in plan
        assert content.count() == 201 and content.where("body_text = 'bb'").count() == 3
        assert content.rdd.getNumPartitions() == 16
        keys = spark.createDataFrame([("P3",), ("P7",)], "pmcid string")
        touched = corpus.touched_buckets(spark, root, keys)
        assert 1 <= len(touched) <= 2
        live = corpus.read_table(spark, root, corpus.METADATA, buckets=touched)
        plan = live._jdf.queryExecution().executedPlan().toString()
        assert "bucket" in plan.split("PartitionFilters: ")[1].split("]")[0]
        keys_there = {r.pmcid for r in live.collect()}
        assert {"P3", "P7"} <= keys_there and len(keys_there) < 60
        assert publish.commit_retractions(spark, root, run, keys, TS) == 2
        assert corpus.read_metadata(spark, root).where("is_retracted").count() == 2
        assert corpus.read_metadata(spark, root).count() == 201
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_quality_scans_each_table_once(spark, tmp_path):
    rows = [("PMC1", "d" * 300), ("PMC1", None), (None, None), (None, "x"), ("P" * 30, None)]
    spark.createDataFrame(rows, "pmcid string, doi string").write.parquet(f"{tmp_path}/m")
    spark.createDataFrame([("PMC1",), ("PMC2",), ("PMC2",), (None,)], "pmcid string").write.parquet(f"{tmp_path}/c")
    found = quality.check_quality(spark.read.parquet(f"{tmp_path}/m"), spark.read.parquet(f"{tmp_path}/c"))
    assert {(x.table, x.rule): x.n_rows for x in found.collect()} == {
        ("articles_metadata", "pmcid_missing"): 2, ("articles_metadata", "pmcid_too_long"): 1,
        ("articles_metadata", "doi_too_long"): 1, ("articles_metadata", "duplicate_key"): 2,
        ("articles_content", "pmcid_missing"): 1, ("articles_content", "duplicate_key"): 1,
        ("articles_content", "orphan"): 3,
    }
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 2 and plan.count("hashpartitioning") == 1
