"""Full load, delta load and feed on archives written by the test."""

import datetime as dt
import shutil

import pytest
from corpus_files import article, write_archive, write_list, write_package
from pyspark.sql import functions as F

from folio_sync.operators.quality import QualityError, SchemaError
from folio_sync.plans.delta_load import NoFullLoad, Options, PackageFailed, delta_load
from folio_sync.plans import staging
from folio_sync.plans.full_load import full_load
from folio_sync.sources import corpus
from folio_sync.streaming.package_feed import package_feed

FULL_TS = dt.datetime(2024, 1, 5, 8)
DELTA_TS = dt.datetime(2024, 1, 20, 8)
T1, T2, T3 = "2024-01-01 12:00:00", "2024-01-10 12:00:00", "2024-01-11 12:00:00"


@pytest.fixture(scope="session")
def loaded(tmp_path_factory, spark):
    """A corpus of three articles after a full load on 2024-01-05."""
    tmp_path = tmp_path_factory.mktemp("loaded")
    write_archive(tmp_path / "base/a.tar.gz", {
        "PMC1.xml": article("PMC1", "One v1", "first"), "PMC2.nxml": article("PMC2", "Two", "second"),
    })
    write_archive(tmp_path / "base/sub/b.tar.gz", {"PMC3.XML": article("PMC3", "Three", "third")})
    manifest = write_list(tmp_path / "oa_file_list.csv", [
        ("a.tar.gz", "PMC1", "11", T1, ""), ("a.tar.gz", "PMC2", "", T1, "no"),
        ("sub/b.tar.gz", "PMC3", "", "", "yes"),
    ])
    root = str(tmp_path / "corpus")
    corpus.initialize(spark, root)
    full_load(spark, root, manifest, str(tmp_path / "base"), run_ts=FULL_TS)
    return tmp_path


@pytest.fixture
def site(tmp_path, loaded):
    """A copy of the loaded corpus for one test."""
    shutil.copytree(loaded, tmp_path / "site")
    return tmp_path / "site", str(tmp_path / "site" / "corpus")


def titles(spark, root):
    return {r.pmcid: r.title for r in corpus.read_metadata(spark, root).collect()}


def flags(spark, root):
    return {r.pmcid: r.is_retracted for r in corpus.read_metadata(spark, root).collect()}


def bodies(spark, root):
    return {r.pmcid: r.body_text for r in corpus.read_content(spark, root).collect()}


def runs(spark, root):
    return [(r.run_type, r.status, r.last_file_processed)
            for r in corpus.read_history(spark, root).orderBy("run_id").collect()]


def test_full_load_fills_both_tables(site, spark):
    _, root = site
    assert titles(spark, root) == {"PMC1": "One v1", "PMC2": "Two", "PMC3": "Three"}
    assert flags(spark, root) == {"PMC1": False, "PMC2": False, "PMC3": True}
    assert bodies(spark, root) == {"PMC1": "first", "PMC2": "second", "PMC3": "third"}
    times = {r.pmcid: r.source_last_updated for r in corpus.read_metadata(spark, root).collect()}
    assert times == {"PMC1": dt.datetime(2024, 1, 1, 12), "PMC2": dt.datetime(2024, 1, 1, 12), "PMC3": None}
    run = corpus.read_history(spark, root).first()
    assert (run.run_type, run.status) == ("FULL", "SUCCESS")
    assert run.metrics["archives_processed"] == 2
    assert run.metrics["total_records_loaded"] == 3


def test_full_load_replaces_and_an_empty_manifest_empties(site, spark):
    tmp_path, root = site
    write_archive(tmp_path / "base/c.tar.gz", {"x.xml": article("PMC9", "Nine")})
    manifest = write_list(tmp_path / "m2.csv", [("c.tar.gz", "PMC9", "", T2, "")])
    full_load(spark, root, manifest, str(tmp_path / "base"), run_ts=FULL_TS)
    assert titles(spark, root) == {"PMC9": "Nine"}
    full_load(spark, root, write_list(tmp_path / "m3.csv", []), str(tmp_path / "base"), run_ts=FULL_TS)
    assert titles(spark, root) == {} and bodies(spark, root) == {}
    assert [r[1] for r in runs(spark, root)] == ["SUCCESS"] * 3


def test_full_load_failure_keeps_the_old_tables(site, spark):
    tmp_path, root = site
    write_archive(tmp_path / "base/d.tar.gz", {"x.xml": article("PMC9"), "y.xml": article("PMC9")})
    manifest = write_list(tmp_path / "m2.csv", [("d.tar.gz", "PMC9", "", T2, "")])
    with pytest.raises(QualityError):
        full_load(spark, root, manifest, str(tmp_path / "base"), run_ts=FULL_TS)
    assert set(titles(spark, root)) == {"PMC1", "PMC2", "PMC3"}
    assert runs(spark, root)[-1][:2] == ("FULL", "FAILED")
    full_load(spark, root, manifest, str(tmp_path / "base"), on_duplicate="latest", run_ts=FULL_TS)
    assert set(titles(spark, root)) == {"PMC9"} and set(bodies(spark, root)) == {"PMC9"}


def test_a_large_archive_is_parsed_by_several_tasks(tmp_path, spark):
    """Only the archive that holds more than a core's share goes through a shuffle."""
    write_archive(tmp_path / "big.tar.gz", {f"{i}.xml": article(f"PMC{i}") for i in range(40)})
    for i in range(20):
        write_archive(tmp_path / f"small{i}.tar.gz", {"x.xml": article(f"PMCS{i}")})
    archives = spark.createDataFrame(
        [("big", f"{tmp_path}/big.tar.gz", 40)] + [(f"s{i}", f"{tmp_path}/small{i}.tar.gz", 1) for i in range(20)],
        "archive_path string, location string, n_articles int",
    )
    staged = staging.stage_archives(spark, archives)
    assert staged.articles.count() == 60
    written = spark.read.parquet(staged.path).where("pmcid IS NOT NULL")
    spread = written.groupBy("archive_path").agg(
        F.countDistinct("_metadata.file_path").alias("n")
    )
    # joins see no text, and the text is copied without a shuffle
    assert "raw_jats_xml" not in staged.articles._jdf.queryExecution().executedPlan().toString()
    texts = staging.texts_of(staged, spark, staging.materialize(spark, staged.articles, "chosen"))
    assert texts.count() == 60
    assert "hashpartitioning" not in texts._jdf.queryExecution().executedPlan().toString()
    files = {r.archive_path: r.n for r in spread.collect()}
    assert files["big"] > 4 and all(n == 1 for name, n in files.items() if name != "big")


def test_paths_with_odd_characters(tmp_path, spark):
    site = tmp_path / "a b+c%20d"
    write_archive(site / "x y+z.tar.gz", {"1.xml": article("PMC1", "One")})
    manifest = write_list(site / "list 1.csv", [("x y+z.tar.gz", "PMC1", "", T1, "")])
    root = str(tmp_path / "corpus")
    corpus.initialize(spark, root)
    full_load(spark, root, manifest, str(site), run_ts=FULL_TS)
    write_package(site / "drop", "2024-01-10", {"1.xml": article("PMC1", "Two")}, [("PMC1", T2, "")])
    delta_load(spark, root, str(site / "drop"), run_ts=DELTA_TS)
    assert titles(spark, root) == {"PMC1": "Two"}


def test_full_load_leaves_out_bad_archives_and_unlisted_articles(tmp_path, spark):
    base = tmp_path / "base"
    good = write_archive(base / "good.tar.gz", {
        "a.xml": article("PMC1"), "b.xml": article("PMC7"), "c.txt": "no", "d.xml": "garbage <article>",
        "e.xml": article("PMC8", year="2024</year><month>Sep</month><year>"),
    })
    write_archive(base / "cut.tar.gz", {f"{i}.xml": article(f"PMC{i}", body="x" * 5000) for i in range(20, 30)})
    data = (base / "cut.tar.gz").read_bytes()
    (base / "cut.tar.gz").write_bytes(data[: len(data) // 2])
    write_archive(base / "wrong.tar.gz", {"a.xml": article("PMC3")})
    write_archive(base / "empty.tar.gz", {})
    listed = [("good.tar.gz", "PMC1", "", T1, ""), ("good.tar.gz", "PMC8", "", T1, ""),
              ("wrong.tar.gz", "PMC3", "", T1, ""), ("gone.tar.gz", "PMC4", "", T1, ""),
              ("empty.tar.gz", "PMC5", "", T1, "")]
    listed += [("cut.tar.gz", f"PMC{i}", "", T1, "") for i in range(20, 30)]
    published = spark.createDataFrame(
        [("good.tar.gz", f"MD5 (good.tar.gz) = {good}"), ("wrong.tar.gz", "MD5 = " + "0" * 32)],
        "archive_path string, sidecar_text string",
    )
    root = str(tmp_path / "corpus")
    corpus.initialize(spark, root)
    full_load(spark, root, write_list(tmp_path / "m.csv", listed), str(base), published, run_ts=FULL_TS)
    assert set(titles(spark, root)) == {"PMC1"} == set(bodies(spark, root))
    metrics = corpus.read_history(spark, root).first().metrics
    assert metrics["archives_failed"] == 3 and metrics["archives_processed"] == 2
    rejects = {(r.stage, r.source, r.key, r.reason)
               for r in spark.read.parquet(f"{root}/rejects/run=1").collect()}
    assert rejects == {
        ("archive", "cut.tar.gz", None, "unreadable"), ("archive", "gone.tar.gz", None, "unreadable"),
        ("archive", "wrong.tar.gz", None, "mismatch"),
        ("article", "good.tar.gz/b.xml", "PMC7", "unlisted"),
        ("article", "good.tar.gz/d.xml", None, "malformed"),
        ("article", "good.tar.gz/e.xml", "PMC8", "bad_date"),
    }


def test_delta_updates_adds_and_retracts(site, spark):
    tmp_path, root = site
    drop = tmp_path / "drop"
    last = write_package(drop, "2024-01-11", {
        "1.xml": article("PMC1", "One v2", "first again"), "2.xml": article("PMC2", "Two v2"),
        "4.xml": article("PMC4", "Four", "fourth"), "5.xml": article("PMC5", "not listed"),
    }, [("PMC1", T3, ""), ("PMC2", T3, "TRUE"), ("PMC4", T3, "")])
    delta_load(spark, root, str(drop), run_ts=DELTA_TS)
    assert titles(spark, root) == {"PMC1": "One v2", "PMC2": "Two", "PMC3": "Three", "PMC4": "Four"}
    assert flags(spark, root) == {"PMC1": False, "PMC2": True, "PMC3": True, "PMC4": False}
    assert bodies(spark, root)["PMC1"] == "first again" and bodies(spark, root)["PMC2"] == "second"
    assert runs(spark, root) == [("FULL", "SUCCESS", None), ("DELTA", "SUCCESS", last)]
    run = corpus.read_history(spark, root).where("run_type = 'DELTA'").first()
    assert run.metrics["total_articles_upserted"] == 2
    assert run.metrics["total_articles_retracted"] == 1
    stamps = {r.pmcid: r.sync_timestamp for r in corpus.read_metadata(spark, root).collect()}
    assert stamps == {"PMC1": DELTA_TS, "PMC2": DELTA_TS, "PMC3": FULL_TS, "PMC4": DELTA_TS}


def test_delta_ignores_old_packages_and_stale_articles(site, spark):
    tmp_path, root = site
    drop = tmp_path / "drop"
    write_package(drop, "2024-01-05", {"1.xml": article("PMC1", "same day")}, [("PMC1", T3, "")])
    write_package(drop, "2024-01-06", {
        "1.xml": article("PMC1", "stale", "stale text"), "2.xml": article("PMC2", "equal"),
        "3.xml": article("PMC3", "Three v2"),
    }, [("PMC1", "2023-01-01 00:00:00", ""), ("PMC2", T1, ""), ("PMC3", "", "")])
    delta_load(spark, root, str(drop), run_ts=DELTA_TS)
    assert titles(spark, root) == {"PMC1": "One v1", "PMC2": "Two", "PMC3": "Three v2"}
    assert bodies(spark, root)["PMC1"] == "stale text"  # texts are not guarded by default


def test_delta_guarded_texts_and_sticky_flags(site, spark):
    tmp_path, root = site
    drop = tmp_path / "drop"
    write_package(drop, "2024-01-06", {
        "1.xml": article("PMC1", "stale", "stale text"), "3.xml": article("PMC3", "Three v2", "new"),
    }, [("PMC1", "2023-01-01 00:00:00", ""), ("PMC3", T2, "")])
    delta_load(spark, root, str(drop), options=Options(guard_content=True, sticky_retractions=True),
               run_ts=DELTA_TS)
    assert bodies(spark, root) == {"PMC1": "first", "PMC2": "second", "PMC3": "new"}
    assert flags(spark, root)["PMC3"] is True


@pytest.mark.parametrize("per_commit", [None, 1])
def test_delta_over_several_packages(site, spark, per_commit):
    tmp_path, root = site
    drop = tmp_path / "drop"
    write_package(drop, "2024-01-10", {
        "1.xml": article("PMC1", "One v2"), "4.xml": article("PMC4", "Four v1"), "5.xml": article("PMC5", "Five v1"),
    }, [("PMC1", T2, ""), ("PMC4", T3, ""), ("PMC5", "", "")])
    write_package(drop, "2024-01-11", {
        "1.xml": article("PMC1", "One v3", "third text"), "4.xml": article("PMC4", "Four late"),
        "5.xml": article("PMC5", "Five v2"),
    }, [("PMC1", T3, ""), ("PMC4", T2, ""), ("PMC5", "", "")], area="oa_other")
    last = write_package(drop, "2024-01-11", {}, [("PMC5", T3, "y")], area="oa_comm")
    retractions = tmp_path / "retractions.csv"
    retractions.write_text("PMCID\nPMC2\nPMC404\n\nPMC2\n")
    delta_load(spark, root, str(drop), str(retractions),
               options=Options(packages_per_commit=per_commit), run_ts=DELTA_TS)
    assert titles(spark, root) == {
        "PMC1": "One v3", "PMC2": "Two", "PMC3": "Three", "PMC4": "Four v1", "PMC5": "Five v2",
    }
    assert flags(spark, root) == {
        "PMC1": False, "PMC2": True, "PMC3": True, "PMC4": False, "PMC5": True,
    }
    assert bodies(spark, root)["PMC1"] == "third text"
    assert last < runs(spark, root)[-1][2] and "oa_other" in runs(spark, root)[-1][2]
    metrics = corpus.read_history(spark, root).where("run_type = 'DELTA'").first().metrics
    assert metrics["archives_processed"] == 3 and metrics["total_articles_retracted"] == 2


def test_failed_delta_keeps_committed_packages_and_reruns(site, spark):
    tmp_path, root = site
    drop = tmp_path / "drop"
    first = write_package(drop, "2024-01-10", {"1.xml": article("PMC1", "One v2")}, [("PMC1", T2, "")])
    too_long = "PMC" + "4" * 30
    second = write_package(drop, "2024-01-11", {"4.xml": article(too_long)}, [(too_long, T2, "")])
    with pytest.raises(QualityError):
        delta_load(spark, root, str(drop), options=Options(packages_per_commit=1), run_ts=DELTA_TS)
    assert runs(spark, root)[-1] == ("DELTA", "FAILED", first)
    assert titles(spark, root) == {"PMC1": "One v2", "PMC2": "Two", "PMC3": "Three"}
    write_package(drop, "2024-01-11", {"4.xml": article("PMC4", "Four")}, [("PMC4", T2, "")])
    delta_load(spark, root, str(drop), run_ts=DELTA_TS)
    assert runs(spark, root)[-1] == ("DELTA", "SUCCESS", second)
    assert titles(spark, root) == {"PMC1": "One v2", "PMC2": "Two", "PMC3": "Three", "PMC4": "Four"}


def test_a_package_that_breaks_a_rule_leaves_those_before_it_in_place(site, spark):
    """In one commit: the packages before it are loaded, it and later ones are not, and the run fails."""
    tmp_path, root = site
    drop = tmp_path / "drop"
    first = write_package(drop, "2024-01-10", {"1.xml": article("PMC1", "One v2")}, [("PMC1", T2, "")])
    second = write_package(drop, "2024-01-11", {"4.xml": article("PMC4"), "5.xml": article("PMC4")}, [("PMC4", T2, "")])
    last = write_package(drop, "2024-01-12", {"5.xml": article("PMC5", "Five")}, [("PMC5", T2, "")])
    with pytest.raises(QualityError, match=second):
        delta_load(spark, root, str(drop), run_ts=DELTA_TS)
    assert runs(spark, root)[-1] == ("DELTA", "FAILED", first)
    assert titles(spark, root) == {"PMC1": "One v2", "PMC2": "Two", "PMC3": "Three"}
    assert reject_reasons(spark, root) == {(second, "duplicate_key")}
    delta_load(spark, root, str(drop), options=Options(on_invalid="pass_over"), run_ts=DELTA_TS)
    assert titles(spark, root) == {"PMC1": "One v2", "PMC2": "Two", "PMC3": "Three", "PMC5": "Five"}
    assert runs(spark, root)[-1] == ("DELTA", "SUCCESS", last)
    metrics = corpus.read_history(spark, root).orderBy(F.desc("run_id")).first().metrics
    assert metrics["archives_processed"] == 2 and metrics["archives_failed"] == 1


def test_delta_passes_over_a_broken_package_unless_told_otherwise(site, spark):
    tmp_path, root = site
    drop = tmp_path / "drop"
    broken = write_package(drop, "2024-01-10", {"1.xml": article("PMC1", "One v2")}, [("PMC1", T2, "")])
    (drop / broken).write_bytes(b"not an archive")
    last = write_package(drop, "2024-01-11", {"4.xml": article("PMC4", "Four")}, [("PMC4", T2, "")])
    with pytest.raises(PackageFailed):
        delta_load(spark, root, str(drop), options=Options(stop_at_failure=True), run_ts=DELTA_TS)
    delta_load(spark, root, str(drop), run_ts=DELTA_TS)
    assert titles(spark, root) == {"PMC1": "One v1", "PMC2": "Two", "PMC3": "Three", "PMC4": "Four"}
    assert runs(spark, root)[-1] == ("DELTA", "SUCCESS", last)


def test_delta_checks_digest_files(site, spark):
    tmp_path, root = site
    drop = tmp_path / "drop"
    wrong = write_package(drop, "2024-01-10", {"1.xml": article("PMC1", "One v2")}, [("PMC1", T2, "")])
    (drop / f"{wrong}.md5").write_text("MD5 = " + "0" * 32)
    write_package(drop, "2024-01-11", {"4.xml": article("PMC4", "Four")}, [("PMC4", T2, "")])
    delta_load(spark, root, str(drop), run_ts=DELTA_TS)
    assert titles(spark, root) == {"PMC1": "One v1", "PMC2": "Two", "PMC3": "Three", "PMC4": "Four"}
    reasons = spark.read.parquet(f"{root}/rejects").where("stage = 'archive'").collect()
    assert [(r.source, r.reason) for r in reasons] == [(wrong, "mismatch")]


def test_delta_without_news_and_without_file_list(site, spark):
    tmp_path, root = site
    drop = tmp_path / "drop"
    delta_load(spark, root, str(drop), str(tmp_path / "absent.csv"), run_ts=dt.datetime(2024, 1, 6))
    assert runs(spark, root)[-1] == ("DELTA", "SUCCESS", None)
    alone = write_package(drop, "2024-01-10", {"1.xml": article("PMC1", "One v2")}, None)
    delta_load(spark, root, str(drop), run_ts=DELTA_TS)
    assert titles(spark, root)["PMC1"] == "One v1"
    assert runs(spark, root)[-1] == ("DELTA", "SUCCESS", alone)


def test_delta_needs_tables_and_a_full_load(tmp_path, spark):
    root = str(tmp_path / "corpus")
    with pytest.raises(SchemaError, match="There is no table"):
        delta_load(spark, root, str(tmp_path))
    corpus.initialize(spark, root)
    corpus.initialize(spark, root)
    with pytest.raises(NoFullLoad):
        delta_load(spark, root, str(tmp_path))
    assert runs(spark, root) == []


def test_compaction_keeps_the_rows(site, spark):
    tmp_path, root = site
    drop = tmp_path / "drop"
    write_package(drop, "2024-01-10", {"1.xml": article("PMC1", "One v2")}, [("PMC1", T2, ""), ("PMC2", T2, "yes")])
    run_id = delta_load(spark, root, str(drop), run_ts=DELTA_TS)
    before = sorted(corpus.read_metadata(spark, root).collect())
    texts = sorted(corpus.read_content(spark, root).collect())
    version = corpus.compact(spark, root, run_id)
    assert corpus.live_versions(spark, root) == [version]
    assert sorted(corpus.read_metadata(spark, root).collect()) == before
    assert sorted(corpus.read_content(spark, root).collect()) == texts


def test_feed_applies_packages_once(site, spark):
    tmp_path, root = site
    drop, checkpoint = tmp_path / "drop", str(tmp_path / "feed")
    write_package(drop, "2024-01-11", {"1.xml": article("PMC1", "One v3", "v3")}, [("PMC1", T3, "")])
    write_package(drop, "2024-01-10", {"1.xml": article("PMC1", "One v2", "v2")}, [("PMC1", T2, ""), ("PMC2", T2, "y")])

    def run():
        query = package_feed(spark, root, str(drop), checkpoint)
        query.awaitTermination()

    run()
    assert titles(spark, root)["PMC1"] == "One v3" and bodies(spark, root)["PMC1"] == "v3"
    assert flags(spark, root)["PMC2"] is True
    n_runs = len(runs(spark, root))
    assert n_runs == 3
    run()
    assert len(runs(spark, root)) == n_runs
    write_package(drop, "2024-01-12", {"4.xml": article("PMC4", "Four")}, [("PMC4", T3, "")])
    run()
    assert titles(spark, root)["PMC4"] == "Four" and len(runs(spark, root)) == n_runs + 1


def reject_reasons(spark, root):
    return {(r.source, r.reason) for r in spark.read.parquet(f"{root}/rejects").collect()}


def test_retractions_do_not_depend_on_the_archive(site, spark):
    """An empty archive, a damaged one, and one that is not needed: the lists count all the same."""
    tmp_path, root = site
    drop = tmp_path / "drop"
    empty = write_package(drop, "2024-01-10", {}, [("PMC1", T2, "yes"), ("PMC3", T2, "")])
    (drop / empty).write_bytes(b"")
    broken = write_package(drop, "2024-01-11", {}, [("PMC2", T2, "yes"), ("PMC4", T2, "")])
    (drop / broken).write_bytes(b"not an archive")
    idle = write_package(drop, "2024-01-12", {}, [("PMC3", T2, "yes")])
    (drop / idle).write_bytes(b"never looked at")
    delta_load(spark, root, str(drop), run_ts=DELTA_TS)
    assert flags(spark, root) == {"PMC1": True, "PMC2": True, "PMC3": True}
    assert reject_reasons(spark, root) == {(empty, "unreadable"), (broken, "unreadable")}
    metrics = corpus.read_history(spark, root).where("run_type = 'DELTA'").first().metrics
    assert metrics["archives_failed"] == 2 and metrics["archives_processed"] == 1


def test_a_package_with_the_wrong_digest_does_not_retract(site, spark):
    tmp_path, root = site
    drop = tmp_path / "drop"
    wrong = write_package(drop, "2024-01-10", {"4.xml": article("PMC4")}, [("PMC4", T2, ""), ("PMC1", T2, "yes")])
    (drop / f"{wrong}.md5").write_text("MD5 = " + "0" * 32)
    delta_load(spark, root, str(drop), run_ts=DELTA_TS)
    assert flags(spark, root) == {"PMC1": False, "PMC2": False, "PMC3": True}


def test_a_bad_member_costs_itself_alone(site, spark):
    tmp_path, root = site
    drop = tmp_path / "drop"
    package = write_package(drop, "2024-01-10", {
        "1.xml": article("PMC1", "One v2"), "2.xml": "nothing", "3.xml": "placeholder",
    }, [("PMC1", T2, "")])
    cut = ("\ufeff" + article("PMC3", "Three v2")).encode("utf-16-le")[:-1]
    write_archive(drop / package, {"1.xml": article("PMC1", "One v2"), "2.xml": "nothing", "3.xml": cut})
    delta_load(spark, root, str(drop), run_ts=DELTA_TS)
    assert titles(spark, root)["PMC1"] == "One v2"
    assert reject_reasons(spark, root) == {(f"{package}/2.xml", "no_article"), (f"{package}/3.xml", "undecodable")}


def test_full_load_reads_digest_files(tmp_path, spark):
    base = tmp_path / "base"
    write_archive(base / "a.tar.gz", {"1.xml": article("PMC1")})
    write_archive(base / "b.tar.gz", {"2.xml": article("PMC2")})
    (base / "b.tar.gz.md5").write_text("MD5 = " + "0" * 32)
    root = str(tmp_path / "corpus")
    corpus.initialize(spark, root)
    listed = write_list(tmp_path / "m.csv", [("a.tar.gz", "PMC1", "", T1, ""), ("b.tar.gz", "PMC2", "", T1, "")])
    full_load(spark, root, listed, str(base), run_ts=FULL_TS)
    assert set(titles(spark, root)) == {"PMC1"}


def test_feed_waits_for_the_list_and_the_archive(site, spark):
    tmp_path, root = site
    drop, checkpoint = tmp_path / "drop", str(tmp_path / "feed")
    name = write_package(drop, "2024-01-10", {"1.xml": article("PMC1", "One v2")}, [("PMC1", T2, "")])
    listed = drop / name.replace(".tar.gz", ".filelist.csv")
    lines, archive = listed.read_bytes(), (drop / name).read_bytes()
    listed.unlink()

    def run():
        package_feed(spark, root, str(drop), checkpoint).awaitTermination()

    run()
    assert titles(spark, root)["PMC1"] == "One v1" and len(runs(spark, root)) == 1
    (drop / name).write_bytes(archive[: len(archive) // 2])
    listed.write_bytes(lines)
    run()
    assert titles(spark, root)["PMC1"] == "One v1" and reject_reasons(spark, root) == {(name, "unreadable")}
    (drop / name).write_bytes(archive)
    run()
    assert titles(spark, root)["PMC1"] == "One v2"
    assert corpus.failed_packages(spark, root).isEmpty()


def test_feed_goes_on_after_failed_packages(site, spark):
    """Spoilt, with the wrong digest, and with rows that break a rule: each between good ones, each counted."""
    tmp_path, root = site
    drop, checkpoint = tmp_path / "drop", str(tmp_path / "feed")
    days = [f"2024-01-{d}" for d in range(10, 17)]
    too_long = "PMC" + "9" * 30
    names = [write_package(drop, day, {"x.xml": article(f"PMC5{i}", f"Title {i}")}, [(f"PMC5{i}", T2, ""), ("PMC1", T2, "y" if i == 1 else "")])
             for i, day in enumerate(days)]
    spoilt, wrong, invalid, twice = names[1], names[2], names[4], names[5]
    good_archive, list_of = (drop / spoilt).read_bytes(), lambda n: drop / n.replace(".tar.gz", ".filelist.csv")
    (drop / spoilt).write_bytes(b"spoilt")
    (drop / f"{wrong}.md5").write_text("MD5 = " + "0" * 32)
    write_archive(drop / invalid, {"x.xml": article(too_long)})
    write_list(list_of(invalid), [("x", too_long, "", T2, ""), ("x", "PMC2", "", T2, "y")])
    write_archive(drop / twice, {"x.xml": article("PMC55"), "y.xml": article("PMC55")})

    def run(**options):
        package_feed(spark, root, str(drop), checkpoint, packages_per_batch=4, **options).awaitTermination()

    def failed():
        return {(r.archive_path, r.attempts, r.reason) for r in corpus.failed_packages(spark, root).collect()}

    run()
    assert set(titles(spark, root)) == {"PMC1", "PMC2", "PMC3", "PMC50", "PMC53", "PMC56"}
    assert flags(spark, root)["PMC1"] is True and flags(spark, root)["PMC2"] is False  # the spoilt one's list counts
    reasons = {(spoilt, "unreadable"), (wrong, "mismatch"), (invalid, "pmcid_too_long"), (twice, "duplicate_key")}
    assert failed() == {(n, 1, why) for n, why in reasons} and reject_reasons(spark, root) == reasons
    assert all(status == "SUCCESS" for _, status, _ in runs(spark, root))
    (drop / spoilt).write_bytes(good_archive)
    run()
    assert titles(spark, root)["PMC51"] == "Title 1"
    assert failed() == {(n, 2, why) for n, why in reasons if n != spoilt}
    run(max_attempts=2)
    assert {n for _, n, _ in failed()} == {2}


def test_feed_runs_on_and_tries_again_by_itself(site, spark):
    """A query without an end: an archive that never comes, an empty one, and one that is replaced."""
    import time

    tmp_path, root = site
    drop = tmp_path / "drop"
    late = write_package(drop, "2024-01-10", {"x.xml": article("PMC60", "Late")}, [("PMC60", T2, "")])
    empty = write_package(drop, "2024-01-11", {}, [("PMC61", T2, ""), ("PMC1", T2, "y")])
    write_package(drop, "2024-01-12", {"x.xml": article("PMC62", "Here")}, [("PMC62", T2, "")])
    archive = (drop / late).read_bytes()
    (drop / late).unlink()
    (drop / empty).write_bytes(b"")
    query = package_feed(spark, root, str(drop), str(tmp_path / "feed"), packages_per_batch=10, available_now=False,
                         wait_seconds=3, retry_seconds=0, poll="1 second")

    def until(what, seconds=90):
        end = time.time() + seconds
        while not what():
            assert query.isActive and time.time() < end, query.exception()
            time.sleep(1)

    try:
        until(lambda: "PMC62" in titles(spark, root))
        until(lambda: {r.archive_path for r in corpus.failed_packages(spark, root).collect()} == {late, empty})
        until(lambda: flags(spark, root)["PMC1"])
        (drop / late).write_bytes(archive)
        until(lambda: "PMC60" in titles(spark, root))
    finally:
        query.stop()


def test_feed_passes_over_packages_older_than_the_full_load(site, spark):
    tmp_path, root = site
    drop = tmp_path / "drop"
    write_package(drop, "2024-01-03", {"9.xml": article("PMC9", "Gone since")}, [("PMC9", T2, "")])
    package_feed(spark, root, str(drop), str(tmp_path / "feed")).awaitTermination()
    assert "PMC9" not in titles(spark, root)
