"""Whole runs, stages on their own, and what they leave in the zones."""

from __future__ import annotations

import logging
import os
import signal
import subprocess
import sys
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from textpipe import PipelineConfig, run
from textpipe.__main__ import main, read_settings
from textpipe.operators import classify
from textpipe.operators.split import assign_split, find_cuts
from textpipe.plans import stages
from textpipe.plans.run import resume, run_stage
from textpipe.sources import manifest
from textpipe.sources.corpus import write_csv
from textpipe.sources.manifest import published

TOPICS = {
    2: ["stock market report", "company earnings rise", "central bank rate", "merger of firms", "oil price falls"],
    1: ["football match result", "tennis final tonight", "coach praises team", "league title race", "olympic medal"],
    3: ["new quantum computer", "software update released", "robot lands on mars", "chip design", "gene study"],
    0: ["peace talks resume", "election in spring", "border agreement", "summit of leaders", "aid convoy arrives"],
}


def news(spark):
    rows = [(text, label) for label, texts in TOPICS.items() for text in texts] * 6
    return spark.createDataFrame(rows, "text string, label int")


def collected(report):
    return sorted((tuple(r) for r in report.collect()), key=str)


def accuracy(report):
    return report.filter("row_name = 'accuracy'").first().f1_score


def test_run_writes_every_artifact(spark, tmp_path):
    cfg = PipelineConfig(base=str(tmp_path))
    report = run(spark, news(spark), cfg)
    assert accuracy(report) == 1.0
    cfg = published(spark, cfg)
    split = spark.read.parquet(cfg.split_path)
    sizes = {(r.split, r.label): r["count"] for r in split.groupBy("split", "label").count().collect()}
    assert sizes == {(s, c): n for s, n in (("train", 24), ("test", 6)) for c in range(4)}
    raw = spark.read.parquet(cfg.raw_path).select("doc_id", "text", "label")
    assert raw.exceptAll(split.drop("split")).isEmpty() and split.drop("split").exceptAll(raw).isEmpty()
    text = spark.read.text(cfg.metrics_path, wholetext=True).first()[0]
    assert text.startswith("Accuracy: 1.0000\n\nClassification Report:\n")
    for path in (cfg.vectorizer_path, cfg.model_path):
        assert (tmp_path / path[len(str(tmp_path)) + 1 :] / "metadata").is_dir()


def test_resuming_gives_the_same_metrics(spark, tmp_path):
    cfg = PipelineConfig(base=str(tmp_path))
    first = collected(run(spark, news(spark), cfg))
    assert collected(resume(spark, cfg)) == first
    cfg = published(spark, cfg)
    report = stages.evaluate(stages.score(spark, cfg), cfg)
    assert collected(report) == first


def test_running_again_replaces_the_artifacts(spark, tmp_path):
    cfg = PipelineConfig(base=str(tmp_path))
    first = collected(run(spark, news(spark), cfg))
    assert collected(run(spark, news(spark), cfg)) == first
    assert spark.read.parquet(published(spark, cfg).split_path).count() == 120


def test_csv_raw_zone(spark, tmp_path):
    cfg = PipelineConfig(base=str(tmp_path), raw_format="csv")
    assert accuracy(run(spark, news(spark), cfg)) == 1.0
    assert spark.read.option("header", True).csv(published(spark, cfg).raw_path).columns == ["text", "label", "doc_id"]


def test_prepare_any_raw_path_without_ids(spark, tmp_path):
    cfg = PipelineConfig(base=str(tmp_path), raw_format="csv")
    write_csv(news(spark), str(tmp_path / "other"))
    stages.prepare(spark, cfg, str(tmp_path / "other"))
    split = spark.read.parquet(cfg.split_path)
    assert split.count() == 120 == split.select("doc_id").distinct().count()


def test_json_raw_zone_keeps_ids(spark, tmp_path):
    cfg = PipelineConfig(base=str(tmp_path), raw_format="json")
    rows = [(text, label, 1_000_000 + i) for i, (text, label) in enumerate(map(tuple, news(spark).collect()))]
    report = run(spark, spark.createDataFrame(rows, "text string, label int, doc_id long"), cfg)
    assert accuracy(report) == 1.0
    split = spark.read.parquet(published(spark, cfg).split_path)
    assert sorted(r.doc_id for r in split.collect()) == list(range(1_000_000, 1_000_120))
    assert dict(split.dtypes)["label"] == "int"


def test_json_without_a_column_says_so(spark, tmp_path):
    cfg = PipelineConfig(base=str(tmp_path), raw_format="json")
    stages.land(news(spark).drop("label"), cfg)
    with pytest.raises(ValueError, match=r"Missing required columns: \['label'\]"):
        stages.prepare(spark, cfg)


@pytest.mark.parametrize("raw_format", ["parquet", "csv", "json"])
def test_repeated_ids_are_kept(spark, tmp_path, caplog, raw_format):
    """A quarter of the rows, and all of one class, share an id."""
    cfg = PipelineConfig(base=str(tmp_path), raw_format=raw_format)
    rows = [(text, label, i if label else 0) for i, (text, label) in enumerate(map(tuple, news(spark).collect()))]
    stages.land(spark.createDataFrame(rows, "text string, label int, doc_id long"), cfg)
    with caplog.at_level(logging.WARNING, logger="textpipe"):
        stages.prepare(spark, cfg)
    assert len(caplog.messages) == 1 and "doc_id repeats its values" in caplog.messages[0]
    split = spark.read.parquet(cfg.split_path)
    got = sorted((r.text, r.label, int(r.doc_id)) for r in split.collect())
    assert got == sorted(rows)
    sizes = {(r.split, r.label): r["count"] for r in split.groupBy("split", "label").count().collect()}
    assert sizes == {(s, c): n for s, n in (("train", 24), ("test", 6)) for c in range(4)}


def test_writing_the_split_shuffles_no_text(spark, tmp_path):
    cfg = PipelineConfig(base=str(tmp_path))
    stages.land(news(spark), cfg)
    raw = spark.read.parquet(cfg.raw_path)
    assigned = assign_split(raw, find_cuts(raw))
    plan = assigned.select("doc_id", "text", "label", "split")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("BroadcastExchange", "")


def test_runs_are_summarized(spark, tmp_path):
    cfg = PipelineConfig(base=str(tmp_path))
    report = run(spark, news(spark), cfg)
    for _ in range(2):
        row = stages.summarize(spark, report, cfg).first()
    assert (row.status, row.accuracy, row.metrics_path) == ("success", 1.0, cfg.metrics_path)
    assert row.timestamp[10] == "T"
    assert spark.read.parquet(cfg.runs_path).count() == 2


def test_degenerate_corpus(spark, tmp_path):
    """All texts have the same tokens, so every prediction is one class."""
    rows = [(f"equal words {i % 4 + 1}", i % 4) for i in range(120)]
    cfg = PipelineConfig(base=str(tmp_path))
    report = run(spark, spark.createDataFrame(rows, "text string, label int"), cfg)
    rows = {r.row_name: r for r in report.collect()}
    assert rows["accuracy"].f1_score == 0.25
    assert sorted(rows[str(c)].precision for c in range(4)) == [0.0, 0.0, 0.0, 0.25]


def test_any_predictions_can_be_evaluated(spark, tmp_path):
    cfg = PipelineConfig(base=str(tmp_path))
    perfect = spark.createDataFrame([(i % 4, i % 4) for i in range(10)], "label int, prediction int")
    assert accuracy(stages.evaluate(perfect, cfg)) == 1.0


def test_text_warnings_come_with_the_split(spark, tmp_path, caplog):
    cfg = PipelineConfig(base=str(tmp_path))
    blank = news(spark).withColumn("text", F.when(F.col("text") == "oil price falls", "  ").otherwise(F.col("text")))
    stages.land(blank, cfg)
    with caplog.at_level(logging.WARNING, logger="textpipe"):
        stages.prepare(spark, cfg)
    assert caplog.messages == ["Found 6 empty text entries"]


def test_null_texts_warn_first_and_fail_at_the_features(spark, tmp_path, caplog):
    cfg = PipelineConfig(base=str(tmp_path))
    holes = news(spark).withColumn("text", F.when(F.col("label") != 3, F.col("text")))
    stages.land(holes, cfg)
    with caplog.at_level(logging.WARNING, logger="textpipe"):
        stages.prepare(spark, cfg)
    assert caplog.messages == ["Found null values in text column"]
    with pytest.raises(ValueError, match="Null documents"):
        stages.featurize(spark, cfg)


def test_labels_without_a_name_still_train(spark, tmp_path):
    cfg = PipelineConfig(base=str(tmp_path))
    odd = news(spark).withColumn("label", F.when(F.col("label") == 3, 7).otherwise(F.col("label")))
    names = stages.named_labels(odd, cfg).select("label", "label_name").distinct().collect()
    assert {r.label: r.label_name for r in names} == {0: "World", 1: "Sports", 2: "Business", 7: None}
    report = run(spark, odd, cfg)
    assert {r.row_name for r in report.collect()} >= {"0", "1", "2", "7"}


def test_stages_check_their_input(spark, tmp_path):
    cfg = PipelineConfig(base=str(tmp_path))
    for stage in (stages.prepare, stages.featurize, stages.score):
        with pytest.raises(FileNotFoundError, match="File not found"):
            stage(spark, cfg)
    stages.land(news(spark), cfg)
    stages.prepare(spark, cfg)
    with pytest.raises(FileNotFoundError, match="vectorizer"):
        stages.load_vectors(spark, cfg, "train")
    stages.land(news(spark).limit(99), cfg)
    with pytest.raises(ValueError, match="DataFrame has 99 rows, minimum required: 100"):
        stages.prepare(spark, cfg)
    stages.land(spark.createDataFrame([("a note", 0)], "body string, topic int"), cfg)
    with pytest.raises(ValueError):
        stages.prepare(spark, cfg)


def test_failing_stage_is_logged_and_raised(spark, tmp_path, caplog, monkeypatch):
    def fail(*args, **kwargs):
        raise RuntimeError("no model today")

    monkeypatch.setattr(classify, "train_classifier", fail)
    with caplog.at_level(logging.ERROR), pytest.raises(RuntimeError, match="no model today"):
        run(spark, news(spark), PipelineConfig(base=str(tmp_path)))
    assert "Run failed in stage train" in caplog.messages


def test_stages_from_the_command_line(spark, tmp_path, capsys):
    write_csv(news(spark).select("label", "text"), str(tmp_path / "corpus"))
    base = ["--base", str(tmp_path / "zones")]
    source = ["--corpus", str(tmp_path / "corpus"), "--format", "csv"]
    main(["land", *base, *source])
    for stage in ("prepare", "featurize", "train", "evaluate"):
        main([stage, *base])
    by_stages = capsys.readouterr().out
    assert by_stages.startswith("Accuracy: 1.0000\n")
    main(["run", *base, *source])
    assert capsys.readouterr().out == by_stages
    assert spark.read.parquet(PipelineConfig(base=base[1]).runs_path).count() == 2
    main(["resume", *base])
    assert capsys.readouterr().out == by_stages
    main(["score", *base, "--out", str(tmp_path / "scored")])
    assert spark.read.parquet(str(tmp_path / "scored")).filter("label = prediction").count() == 24
    for wrong in ([], ["--set", "versions={}"], ["--set", "max_feature=3"], ["--set", "seed"]):
        with pytest.raises(SystemExit):
            main(["run", *base, *source[:2 * bool(wrong)], *wrong])


def test_settings_from_the_command_line(spark, tmp_path, capsys):
    """A CSV raw zone, another vocabulary and another seed, stage by stage and resumed."""
    write_csv(news(spark).select("label", "text"), str(tmp_path / "corpus"))
    (tmp_path / "settings.json").write_text('{"raw_format": "csv", "max_features": 9, "seed": 1}')
    base = ["--base", str(tmp_path / "zones"), "--settings", str(tmp_path / "settings.json")]
    changed = ["--set", "seed=7", "--set", "stop_words=null", "--set", "vocabulary_name=words.parquet"]
    source = ["--corpus", str(tmp_path / "corpus"), "--format", "csv"]
    main(["land", *base, *source])
    raw = published(spark, PipelineConfig(base=base[1], raw_format="csv")).raw_path
    main(["prepare", *base, *changed, "--raw", raw])
    for stage in ("featurize", "train", "evaluate"):
        main([stage, *base, *changed])
    assert capsys.readouterr().out.startswith("Accuracy: ")
    cfg = PipelineConfig(base=base[1], raw_format="csv", max_features=9, seed=7, stop_words=None,
                         vocabulary_name="words.parquet")
    assert cfg == read_settings(base[1], base[3], changed[1::2])
    cfg = published(spark, cfg)
    assert spark.read.parquet(cfg.vocabulary_path).count() == 9
    whole = assign_split(spark.read.parquet(cfg.keyed_path), find_cuts(spark.read.parquet(cfg.keyed_path), seed=7), seed=7)
    split = spark.read.parquet(cfg.split_path).select("doc_id", "split")
    assert whole.select("doc_id", "split").exceptAll(split).isEmpty()


def _calls(monkeypatch) -> list[str]:
    """The names of the stages that are run from now on."""
    ran: list[str] = []

    def noted(name, work):
        def stage(*args, **kwargs):
            ran.append(name)
            return work(*args, **kwargs)

        return stage

    for name in ("land", "prepare", "featurize", "train", "evaluate"):
        monkeypatch.setattr(stages, name, noted(name, getattr(stages, name)))
    return ran


def test_resume_runs_what_is_out_of_date(spark, tmp_path, monkeypatch):
    cfg = PipelineConfig(base=str(tmp_path))
    first = collected(run(spark, news(spark), cfg))
    ran = _calls(monkeypatch)
    assert collected(resume(spark, cfg)) == first and ran == []
    resume(spark, replace(cfg, max_iter=20))
    assert ran == ["train", "evaluate"]
    ran.clear()
    resume(spark, replace(cfg, max_iter=20))
    assert ran == []
    resume(spark, replace(cfg, max_iter=20, max_features=12))
    assert ran == ["featurize", "train", "evaluate"]
    ran.clear()
    assert collected(resume(spark, cfg)) == first and ran == ["featurize", "train", "evaluate"]
    ran.clear()
    resume(spark, replace(cfg, seed=7))
    assert ran == ["prepare", "featurize", "train", "evaluate"]


def test_resume_sees_changed_files(spark, tmp_path, monkeypatch):
    cfg = PipelineConfig(base=str(tmp_path / "zones"))
    path = str(tmp_path / "corpus")
    news(spark).write.parquet(path)
    corpus = spark.read.parquet(path)
    ran = _calls(monkeypatch)
    resume(spark, cfg, corpus)
    assert ran == ["land", "prepare", "featurize", "train", "evaluate"]
    ran.clear()
    resume(spark, cfg, spark.read.parquet(path))
    assert ran == []
    news(spark).limit(40).write.mode("append").parquet(path)
    resume(spark, cfg, spark.read.parquet(path))
    assert ran == ["land", "prepare", "featurize", "train", "evaluate"]
    assert spark.read.parquet(published(spark, cfg).split_path).count() == 160


@pytest.mark.parametrize("stage", ["land", "prepare", "featurize", "train", "evaluate"])
def test_a_failed_run_leaves_the_former_one(spark, tmp_path, monkeypatch, stage):
    """The second run writes some of a stage and stops; then it is resumed."""
    cfg = PipelineConfig(base=str(tmp_path))
    first = collected(run(spark, news(spark), cfg))
    held = published(spark, cfg)
    split = collected(spark.read.parquet(held.split_path))
    other = replace(cfg, seed=5)
    more = news(spark).union(news(spark).limit(20))

    with monkeypatch.context() as patched:
        work = getattr(stages, stage)

        def stopped(*args, **kwargs):
            work(*args, **kwargs)
            raise KeyboardInterrupt

        patched.setattr(stages, stage, stopped)
        with pytest.raises(KeyboardInterrupt):
            run(spark, more, other)
    assert published(spark, cfg) == held
    assert collected(spark.read.parquet(held.split_path)) == split
    assert collected(spark.read.parquet(held.metrics_table_path)) == first
    assert collected(stages.evaluate(stages.score(spark, held), replace(held, reports_dir="again"))) == first

    ran = _calls(monkeypatch)
    every = ["land", "prepare", "featurize", "train", "evaluate"]
    resume(spark, other, more)
    assert ran == (every if stage in ("land", "prepare") else every[every.index(stage) :]) or ran == every
    assert spark.read.parquet(published(spark, other).split_path).count() == 140
    # Only this run and the former one are left, and what was stopped is gone.
    versions = {p.name for zone in ("data/raw", "data/processed", "models", "reports") for p in (tmp_path / zone).iterdir()}
    known = {f"v-{v}" for c in (held, published(spark, cfg)) for v in c.versions.values()}
    assert versions <= known and manifest.pending(spark, cfg) is None


def test_killed_process(spark, tmp_path):
    """A process that is killed while it trains leaves the former run, and a run to go on with."""
    cfg = PipelineConfig(base=str(tmp_path / "zones"))
    first = collected(run(spark, news(spark), cfg))
    held = published(spark, cfg)
    news(spark).write.parquet(str(tmp_path / "corpus"))
    script = f"""
import os, signal, sys
sys.path.insert(0, {os.getcwd()!r})
from textpipe.__main__ import main
from textpipe.operators import classify
classify.train_classifier = lambda *a, **k: os.kill(os.getpid(), signal.SIGKILL)
main(["run", "--base", {cfg.base!r}, "--corpus", {str(tmp_path / "corpus")!r}, "--set", "seed=9"])
"""
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, timeout=300)
    assert done.returncode == -signal.SIGKILL
    assert published(spark, cfg) == held and collected(spark.read.parquet(held.metrics_table_path)) == first
    assert set(manifest.pending(spark, cfg)) == {"land", "prepare", "featurize"}
    resume(spark, replace(cfg, seed=9))
    assert published(spark, cfg).versions["prepare"] != held.versions["prepare"]


def test_single_stages_count_at_once(spark, tmp_path):
    cfg = PipelineConfig(base=str(tmp_path))
    run(spark, news(spark), cfg)
    before = published(spark, cfg).versions
    run_stage(spark, replace(cfg, seed=3), "prepare")
    after = published(spark, cfg).versions
    assert {s for s in after if after[s] != before[s]} == {"prepare"}
    # What was made from the former split is out of date.
    resume(spark, replace(cfg, seed=3))
    assert {s for s in after if published(spark, cfg).versions[s] != before[s]} == {"prepare", "featurize", "train", "evaluate"}


def test_swapped_file(spark, tmp_path):
    path = str(tmp_path / "m.json")
    assert manifest.read_json(spark, path) is None
    for k in range(3):
        manifest.swap_json(spark, path, {"k": k})
        assert manifest.read_json(spark, path) == {"k": k}
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["m.json"]


def test_sizes_and_results_are_logged(spark, tmp_path, caplog):
    with caplog.at_level(logging.INFO, logger="textpipe"):
        run(spark, news(spark), PipelineConfig(base=str(tmp_path)))
    log = "\n".join(caplog.messages)
    assert "Train with 96 rows and test with 24 rows" in log
    assert "Train matrix 96 x " in log and "test matrix 24 x " in log
    assert "Trained on 96 rows x " in log and "Accuracy: 1.0000" in log


def test_texts_are_cut_once_for_a_split(spark, tmp_path, monkeypatch):
    """After a change of the solver nothing reads texts, after one of the vocabulary no terms are counted."""
    cfg = PipelineConfig(base=str(tmp_path))
    first = collected(run(spark, news(spark), cfg))

    def fail(*args, **kwargs):
        raise AssertionError("texts are cut again")

    with monkeypatch.context() as patched:
        patched.setattr(stages, "load_vectors", fail)
        patched.setattr(stages, "count_terms", fail)
        assert accuracy(resume(spark, replace(cfg, max_iter=20))) == 1.0
        resume(spark, replace(cfg, max_features=12))
        assert spark.read.parquet(published(spark, cfg).vocabulary_path).count() == 12
        assert collected(resume(spark, cfg)) == first
    with monkeypatch.context() as patched:
        patched.setattr(stages, "count_terms", fail)
        with pytest.raises(AssertionError, match="cut again"):
            resume(spark, replace(cfg, seed=7))


@pytest.mark.parametrize("sketch", [False, True])
def test_stored_counts_give_the_vectors_of_the_texts(spark, tmp_path, sketch):
    cfg = PipelineConfig(base=str(tmp_path), sketch_vocabulary=sketch)
    run(spark, news(spark), cfg)
    cfg = published(spark, cfg)
    for split in ("train", "test"):
        stored, cut = (f(spark, cfg, split).collect() for f in (stages.stored_vectors, stages.load_vectors))
        assert sorted(map(str, stored)) == sorted(map(str, cut)) and len(cut) in (96, 24)
    # A run of before has stored no counts.
    held = replace(cfg, counts_name="none.parquet")
    assert stages.stored_vectors(spark, held, "test").count() == 24


def test_another_split_counts_its_own_terms(spark, tmp_path):
    """In a folder without versions, counts of the former split do not stay."""
    cfg = PipelineConfig(base=str(tmp_path))
    for label, n in ((0, 40), (1, 80)):
        words = [(f"term{label}{i % 4} other", i % 4) for i in range(120 + n)]
        stages.land(spark.createDataFrame(words, "text string, label int"), cfg)
        stages.prepare(spark, cfg)
        vectorizer, *_ = stages.featurize(spark, cfg)
        terms = {r.term for r in vectorizer.vocabulary.collect()}
        assert terms >= {f"term{label}{k}" for k in range(4)} and not any(t.startswith(f"term{1 - label}") for t in terms)
