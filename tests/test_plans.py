"""Configuration, catalog, reports, whole runs, command lines and streams."""

import json

import pytest

from dialoom.operators import stats
from dialoom.plans import cli, pipeline, reports
from dialoom.schemas import CANONICAL, ConfigError, CurationReport, StatisticsReport
from dialoom.sources.catalog import Catalog, DatasetEntry
from dialoom.streaming.conversations import clean_stream, dedup_stream


def test_catalog(tmp_path):
    one = {"key": "k", "name": "n", "source": "local", "local_path": "p"}
    c = Catalog.from_dict({"datasets": [one, {"key": "h", "name": "n", "source": "huggingface", "dataset_id": "a/b"}]})
    assert c.keys() == ["k", "h"] and len(c) == 2 and "k" in c and c.get("zz") is None and c["h"].dataset_id == "a/b" and c.by_dataset_id("a/b").key == "h" and [e.key for e in c] == ["k", "h"]
    with pytest.raises(KeyError, match="registered"):
        c["zz"]
    for bad, kind in (({}, KeyError), ({"datasets": 3}, TypeError), ({"datasets": [one, one]}, ValueError), ({"datasets": [{"key": "x", "name": "n", "source": "local"}]}, ValueError), ({"datasets": [{"key": "x", "name": "n", "source": "huggingface"}]}, ValueError)):
        with pytest.raises(kind):
            Catalog.from_dict(bad)
    with pytest.raises(Exception):  # noqa: B017
        DatasetEntry(**one).key = "other"
    (tmp_path / "c.yaml").write_text(json.dumps({"datasets": [one]}))
    assert Catalog.from_yaml(tmp_path / "c.yaml").keys() == ["k"]


def config(folder, **more):
    return {
        "datasets": ["x/grouped", "x/json_dialog", "x/pairs"], "split": "train", "validation": {}, "sampling": {"sample_size": 3, "seed": 42}, "dataset_version": "1", "outputs": {k: f"{folder}/{k}" for k in pipeline.OUTPUTS},
        "curation": {"seed": 42, "split_ratio": 0.8, "source_caps": {"x/grouped": 5}}, **more,
    }


@pytest.mark.parametrize("change", [{"datasets": []}, {"datasets": [1]}, {"split": " "}, {"validation": 3}, {"sampling": {"sample_size": "x", "seed": 1}}, {"outputs": {}}, {"dataset_version": ""}, {"curation": {"split_ratio": 1.0}}, {"curation": {"seed": "x"}}, {"curation": {"source_caps": {"a": 0}}}, {"curation": {"system_prompt_file": 3}}])
def test_config_errors(change):
    with pytest.raises(ConfigError):
        pipeline.check_pipeline_config(config("f") | change)


def test_config_files(tmp_path):
    with pytest.raises(ConfigError, match="not found"):
        pipeline.load_config(str(tmp_path / "none"))
    (tmp_path / "c").write_text(json.dumps({k: v for k, v in config("f").items() if k != "dataset_version"}))
    pipeline.load_config(str(tmp_path / "c"), audit=True)
    with pytest.raises(ConfigError, match="dataset_version"):
        pipeline.load_config(str(tmp_path / "c"))


LONG = "that is a reply which is long enough to be a real answer to what was said before"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("corpus")
    g = [(f"g{k}", i, "sad", "p", str(i % 2), f"hello number {k}_comma_ turn {i}" if i % 2 == 0 else f"{LONG} {k} now.Next one", None, "") for k in range(12) for i in range(4)] + [("lone", 0, "x", "p", "0", "only", None, ""), ("bad", 0, "x", "p", "0", "", None, "")]
    spark.createDataFrame(g, "conv_id string, utterance_idx int, context string, prompt string, speaker_idx string, utterance string, selfeval string, tags string").coalesce(1).write.parquet(str(base / "grouped" / "train.parquet"))
    d = [(json.dumps({"emotion_type": "joy", "dialog": [{"text": f"I am here {k}", "speaker": "usr"}, {"text": f"{LONG} {k}", "speaker": "sys"}]}),) for k in range(6)] + [("broken",)]
    spark.createDataFrame(d, "text string").coalesce(1).write.parquet(str(base / "dialog.parquet"))
    p = [(f"question {k % 4}", f"{LONG} &amp; {k % 4}") for k in range(6)] + [(" ", "x")]
    spark.createDataFrame(p, "Context string, Response string").coalesce(1).write.parquet(str(base / "pairs.parquet"))
    entries = [("grouped", "x/grouped", "grouped"), ("dialog", "x/json_dialog", "dialog.parquet"), ("pairs", "x/pairs", "pairs.parquet")]
    raw = {"datasets": [{"key": k, "name": k, "source": "local", "dataset_id": i, "local_path": str(base / at)} for k, i, at in entries]}
    (base / "catalog.json").write_text(json.dumps(raw))
    return base, Catalog.from_dict(raw)


def test_pipeline_end_to_end(spark, corpus, tmp_path):
    base, catalog = corpus
    c = pipeline.check_pipeline_config(config(str(tmp_path)))
    plan = pipeline.dry_run(c, catalog)
    assert "x/grouped (parse_grouped -> normalize_alternating)" in plan and "x/grouped: 5" in plan
    manifest, report = pipeline.run_pipeline(spark, c, catalog)
    assert (manifest["total_conversations_before"], manifest["duplicates_removed"]) == (24, 2)
    assert report.counts_before == {"x/grouped": 12, "x/json_dialog": 6, "x/pairs": 4} and report.counts_after_sampling == {"x/grouped": 5, "x/json_dialog": 6, "x/pairs": 4}
    assert (report.num_train, report.num_validation) == (12, 3) and report.cleaning["replacements"] == {"comma": 24, "html_entity": 4, "missing_space": 24}
    train = [json.loads(x) for x in open(tmp_path / "train_jsonl")]
    assert len(train) == 12 and all(set(x) == {"messages"} for x in train)
    assert "| `x/pairs` | 4 | 4 | 4 | 26.67% |" in open(tmp_path / "curation_report_md").read()
    assert json.load(open(tmp_path / "duplicate_report_json"))["total_duplicates_found"] == 2 and "| pair_train_0 | pair_train_4 |" in open(tmp_path / "duplicate_report_md").read()
    assert json.load(open(tmp_path / "statistics_json"))["total_conversations"] == 22 and len(json.load(open(tmp_path / "review_sample_json"))) == 3
    assert "PIPELINE EXECUTION COMPLETED" in reports.pipeline_console(manifest, c["outputs"], report)
    # The same seed gives the same files.
    first = open(tmp_path / "train_jsonl").read()
    pipeline.run_pipeline(spark, c, catalog)
    assert open(tmp_path / "train_jsonl").read() == first
    with pytest.raises(ConfigError, match="not in the catalog"):
        pipeline.dry_run(c | {"datasets": ["zz"]}, catalog)
    assert pipeline.build_curator({"curation": {"enabled": False}}) is None
    with pytest.raises(ConfigError, match="prompt"):
        pipeline.build_curator({"curation": {"system_prompt_file": str(tmp_path / "none")}})


def test_audit(spark, corpus, tmp_path):
    _, catalog = corpus
    losses = pipeline.run_audit(spark, config(str(tmp_path)), catalog, str(tmp_path / "a.md"), str(tmp_path / "b.md"), str(tmp_path / "ex"))
    at = {(r.stage, r.dataset): r for r in losses.collect()}
    assert at["Loaded", "x/grouped"].n == 50 and at["Parsed", "x/grouped"].n == 13 and at["Filtered", "x/grouped"].n == 12 and at["Merged", "Total"].n == 24 and at["Loaded", "Total"].loss_percent is None
    assert "| Filtered | 12 | 7.69% | 6 | 0.00% | 6 | 0.00% | 24 | 4.00% |" in (tmp_path / "a.md").read_text()
    assert "| Conversation has fewer than 2 messages | 1 | 100.00% |" in (tmp_path / "b.md").read_text() and (tmp_path / "ex" / "conversation_has_fewer_than_2_messages.md").exists()


def test_stage_losses(spark):
    rows = [("Loaded", "a", 100), ("Parsed", "a", 90), ("Loaded", "b", 0), ("Parsed", "b", 0), ("Nonsense", "a", 5)]
    at = {(r.stage, r.dataset): r.loss_percent for r in stats.stage_losses(spark.createDataFrame(rows, "stage string, dataset string, n long")).collect()}
    assert at == {("Loaded", "a"): None, ("Parsed", "a"): 10.0, ("Loaded", "b"): None, ("Parsed", "b"): 0.0, ("Loaded", "Total"): None, ("Parsed", "Total"): 10.0}


def test_report_texts():
    assert "_No text repairs were required._" in reports.curation_md(CurationReport()) and "_No conversations were dropped._" in reports.curation_md(CurationReport())
    s = StatisticsReport(3, {"b": 1, "a": 2}, {"b": 33.33, "a": 66.67}, 2.67, 2.0, 2, 4, 13.75, 17.5, 26, {"None": 2})
    assert reports.statistics_md(s).index("| a | 2 | 66.67% |") < reports.statistics_md(s).index("| b | 1 | 33.33% |") and "- **Median Turns**: 2.0" in reports.statistics_md(s)
    assert reports.example_file_name("Message has empty/null content") == "message_has_empty_null_content.md" and reports.inspection_file_name("A b/C") == "a_b_c.md"


def test_command_lines(spark, corpus, tmp_path, capsys):
    base, _ = corpus
    (tmp_path / "c.json").write_text(json.dumps(config(str(tmp_path))))
    at = ["--catalog", str(base / "catalog.json")]
    assert cli.main([*at, "run", "--config", str(tmp_path / "c.json"), "--dry-run"], spark) == 0 and "DRY-RUN" in capsys.readouterr().out
    assert cli.main([*at, "parse", "pairs"], spark) == 0 and "Skipped conversations: 1" in capsys.readouterr().out
    assert cli.main([*at, "inspect", "pairs", "--output", str(tmp_path)], spark) == 0 and "### Data Quality" in (tmp_path / "x_pairs.md").read_text()
    assert cli.main([*at, "run", "--config", str(tmp_path / "none")], spark) == 1
    assert cli.main([*at, "run", "--config", str(tmp_path / "c.json")], spark) == 0
    assert cli.main(["export", str(tmp_path / "train_jsonl"), str(tmp_path / "e"), "--split-ratio", "0.5"], spark) == 0 and len(open(tmp_path / "e" / "train.jsonl").readlines()) == 6
    assert cli.main(["tokens", str(tmp_path / "train_jsonl"), str(tmp_path / "t")], spark) == 0 and json.load(open(tmp_path / "t" / "token_statistics.json"))["total_conversations"] == 12
    assert cli.main([*at, "audit", "--config", str(tmp_path / "c.json"), "--output", str(tmp_path / "audit")], spark) == 0


def test_streams(spark, tmp_path):
    good = (0, "a", "s", ("t", "s", "0", None), [("user", "hi  there"), ("assistant", LONG)])
    rows = [good, (1, "b", *good[2:]), (2, "c", "s", ("t", "s", "2", None), [("user", "x")])]
    spark.createDataFrame(rows, CANONICAL).selectExpr("*", "timestamp'2024-01-01' AS at").write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
    q = dedup_stream(clean_stream(source), "at").writeStream.format("memory").queryName("curated").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    out = spark.table("curated").collect()
    assert len(out) == 1 and out[0].messages[0].content == "hi there"


def test_without_optional_subpackage():
    import subprocess
    import sys

    code = "import sys; sys.modules['dialoom.llm'] = None; import __spark_entry__ as e; assert len(e.queries()) > 50 and set(e.oracle_sql()) <= set(e.queries())"
    assert subprocess.run([sys.executable, "-c", code], cwd=__file__.rsplit("/tests/", 1)[0]).returncode == 0
