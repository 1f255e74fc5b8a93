"""Stored reviews, vectors and contracts."""

import inspect

import pytest
from pyspark.sql import functions as F

from convolens.functions import phrases
from convolens.operators import contracts, language, linking, ontology, policy, vector_store
from convolens.sources import records

ONTOLOGY = str(__import__("pathlib").Path(__file__).resolve().parent.parent / "configs" / "demo.yaml")


def test_review_session(spark, tmp_path):
    folder = f"file://{tmp_path}/reviews"
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "item_id string")
    with policy.ReviewSession(spark, folder) as session:
        assert session.table("items") is None
        session.put("items", rows("a", "b"))
        session.put("groups", rows("g"))
    with pytest.raises(ValueError), policy.ReviewSession(spark, folder) as session:
        session.put("items", rows("never"))
        raise ValueError
    now = policy.ReviewSession(spark, folder)
    assert sorted(r.item_id for r in now.table("items").collect()) == ["a", "b"]
    with now as session:
        session.put("items", session.table("items").where("item_id = 'b'"))
    assert [r.item_id for r in now.table("items").collect()] == ["b"] and [r.item_id for r in now.table("groups").collect()] == ["g"]


def test_export_import_and_migrations(spark, tmp_path):
    schema = "decision_id string, item_id string, group_id string, action string, created_at timestamp"
    old = spark.sql("select 'd1' decision_id, 'i1' item_id, cast(null as string) group_id, 'accept' action, timestamp '2024-01-01' created_at")
    new = spark.sql("select 'd1' decision_id, 'i1' item_id, cast(null as string) group_id, 'reject' action, timestamp '2024-01-02' created_at union all select 'd2', 'i2', 'g', 'accept', timestamp '2024-01-01' union all select 'd3', 'i3', 'g', null, timestamp '2024-01-01'")
    policy.export_reviews(new, f"file://{tmp_path}/out")
    got = {r.decision_id: r.action for r in policy.import_decisions(spark, f"file://{tmp_path}/out", old, schema).collect()}
    assert got == {"d1": "reject", "d2": "accept"}
    store = f"file://{tmp_path}/store"
    assert policy.schema_version(spark, store) == 0 and not policy.ready(spark, store)
    assert policy.migrate(spark, store) == [1, 2] and policy.ready(spark, store) and policy.migrate(spark, store) == []
    assert spark.createDataFrame([], policy.TASK_SCHEMA).count() == 0 and spark.createDataFrame([], policy.ANNOTATION_SCHEMA).count() == 0


def test_overlay_problems():
    base = ontology.load(ONTOLOGY)
    assert policy.overlay_problems(base, {"alias_contributions": [{"alias": "acn", "canonical_entity_id": "brand.acorn"}]}) == []
    assert policy.overlay_problems(base, {"alias_contributions": [{"alias": "acn", "canonical_entity_id": "nobody"}]}) == ["acn: entity nobody is unknown"]


def test_vector_namespaces(spark, tmp_path):
    folder = f"file://{tmp_path}/vectors"
    items = spark.createDataFrame([("a", [1.0, 0.0], "red", {"source": "ontology"}), ("b", [0.0, 1.0], "blue", None)], "item_id string, vector array<double>, text string, metadata map<string,string>")
    expected = vector_store.Expected(namespace="n", model="m", dimension=2)
    assert vector_store.load(spark, folder, "n", expected) is None
    made = vector_store.save(items, folder, "n", model="m")
    assert made["item_count"] == 2 and made["corpus_hash"] == vector_store.corpus_hash(items.orderBy(F.desc("item_id")))
    assert vector_store.load(spark, folder, "n", expected).count() == 2
    of = lambda **x: vector_store.state(made, vector_store.Expected(**x))
    assert of(model="other", dimension=3) == ("incompatible", ["dimension_mismatch", "model_mismatch"]) and of(corpus_hash="x") == ("stale", ["corpus_hash_mismatch"]) and of(corpus_hash=made["corpus_hash"]) == ("valid", [])
    assert vector_store.state(made | {"corpus_hash": None}, vector_store.Expected(corpus_hash="x"))[0] == "refresh_required" and vector_store.state(None, None)[0] == "missing"
    vector_store.reset(spark, folder, "n")
    assert vector_store.manifest(spark, folder, "n") is None and set(vector_store.ACTION) == {"missing", "valid", "incompatible", "stale", "refresh_required"}


def test_pool_and_taxonomy(spark):
    from convolens.operators.vectors import hashed_encoder

    encode = hashed_encoder()
    names = [("1", "brand.acorn", "ontology", "acorn"), ("2", "brand.acorn", "review", "acorn store"), ("3", "brand.birch", "ontology", "birch mobile")]
    items = spark.createDataFrame([(i, e, s, encode([t])[0]) for i, e, s, t in names], "item_id string, canonical_entity_id string, source string, vector array<double>")
    got = {(r.query_id, r.place): (r.canonical_entity_id, r.score) for r in vector_store.rank_pool(spark.createDataFrame([("q", "ACORN"), ("p", "birch-mobile")], "query_id string, text string"), items).collect()}
    assert got["q", 1][0] == "brand.acorn" and got["q", 1][1] >= 0.92 and got["p", 1][0] == "brand.birch"
    prototypes = spark.createDataFrame([("price", "price"), ("price", "too expensive"), ("delivery", "late delivery")], "label string, prototype string")
    mapped = {(r.phrase, r.place): r for r in vector_store.map_phrases(spark.createDataFrame([("price",), ("delivery was late",)], "phrase string"), prototypes).collect()}
    assert (mapped["price", 1].label, mapped["price", 1].score) == ("price", 0.995) and mapped["delivery was late", 1].label == "delivery"
    assert mapped["price", 1].ambiguity_gap > 0.5
    rows = spark.createDataFrame([("late delivery", "late delivery", 0.5), ("late", "other thing", 0.5), (None, "x", 0.5)], "a string, b string, score double")
    out = {r.a: (r.score, r.reranked) for r in vector_store.rerank(rows, "a", "b").collect()}
    assert out["late delivery"] == (0.65, True) and out["late"][0] < 0.5 and out[None] == (0.5, False)


def test_prototypes_and_lexicon(spark):
    o = ontology.load(ONTOLOGY)
    o["topics"][0] |= {"related_aspect_ids": ["delivery"]}
    texts = ontology.prototype_texts(o, "brand.acorn")
    assert texts["name"] == ["Acorn", "acorn store", "acorn co", "acornco"] and texts["topic"] == ["Delivery experience"] and texts["issue"] == ["Delay"] and "late" not in texts["phrase"]
    assert ontology.prototype_table(spark, o).where("canonical_entity_id = 'brand.birch'").count() == 2
    lexicon = ontology.phrase_lexicon(o)
    assert "birch mobile" in lexicon and "acorn" not in lexicon
    got = phrases.prepare(spark.createDataFrame([("The BIRCH-mobile shop",), ("",), (None,)], "text string"), lexicon, "query").collect()
    assert [r.prepared for r in got] == ["query: the birch_mobile shop", "query: <empty>", None]


def test_blended_language(spark):
    rows = [([("__label__fr", 0.9), ("en", 0.05), ("de", 0.01)], "zzz"), ([("en", 0.3)], "der die das und ist"), (None, "zzz"), ([("en", 0.4), ("fr", 0.35)], "zzz"), ([("en", 0.9)], "  ")]
    df = spark.createDataFrame(rows, "model array<struct<label: string, probability: double>>, text string")
    got = [tuple(r.l) for r in df.select(language.blended(F.col("model"), F.col("text")).alias("l")).collect()]
    assert got[0] == ("fr", 0.9) and got[1] == ("de", 0.6912) and got[2] == ("unknown", 0.0) and got[3] == ("mixed", 0.55) and got[4] == ("unknown", 0.0)


def test_snapshots_cache_and_archives(spark, tmp_path):
    import zipfile

    from convolens.operators import validation, vectors

    folder = f"file://{tmp_path}/topics"
    assert records.latest_snapshot(spark, folder) is None
    for run in ("run-1", "run-2"):
        records.save_snapshot(spark.createDataFrame([(run,)], "name string"), folder, run)
    assert records.latest_snapshot(spark, folder).first().name == "run-2" and records.latest_snapshot(spark, folder, "run-2").first().name == "run-1"
    calls = spark.sparkContext.accumulator(0)

    def encode(texts):
        calls.add(len(texts))
        return [[float(len(t))] for t in texts]

    for rows in ([(1, "a"), (2, "bb"), (3, "a")], [(4, "bb"), (5, "ccc")]):
        got = {r.id: r.vector for r in vectors.embed_stored(spark.createDataFrame(rows, "id long, text string"), f"file://{tmp_path}/cache", encode, "m").collect()}
        assert got == {i: [float(len(t))] for i, t in rows}
    assert calls.value == 3
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        for name in ("x/b.jsonl", "a.jsonl", "__MACOSX/x/._b.jsonl", "notes.txt"):
            z.writestr(name, "{}")
    assert records.inspect(spark, str(tmp_path / "b.zip")) == {"kind": "zip", "entries": 2, "first": ["a.jsonl", "x/b.jsonl"], "warnings": []}
    profile = spark.createDataFrame([("content.language", 0, 2, ""), ("a.b", 2, 0, "x|y")], "field string, present_count long, missing_count long, example_values string")
    text = validation.markdown({"total_records": 2, "valid_records": 1, "invalid_records": 1}, spark.createDataFrame([("POST", 1)], "value string, count long"), profile)
    assert "- valid records: 1" in text and "| POST | 1 |" in text and "| a.b | 2 | 0 | x\\|y |" in text and "No record names its language" in text


def test_copy_if_different(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    assert not records.copy_if_different(spark, str(tmp_path / "a.txt"), f"file://{tmp_path}/a.txt")
    assert records.copy_if_different(spark, str(tmp_path / "a.txt"), str(tmp_path / "b.txt")) and (tmp_path / "b.txt").read_text() == "x"


def test_commands(spark, tmp_path, capsys, monkeypatch):
    import json

    from convolens import cli

    monkeypatch.setattr(cli, "session", lambda *a: spark)
    store, out = f"file://{tmp_path}/store", f"file://{tmp_path}/in"
    assert cli.main(["db-current", store]) == 0 and cli.main(["db-upgrade", store]) == 0
    said = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert said == [{"version": 0, "ready": False}, {"applied": [1, 2], "version": 2}]
    spark.sql("select 'd1' decision_id, 'i1' item_id, cast(null as string) group_id, 'accept' action, timestamp '2024-01-01' created_at").write.json(out)
    assert cli.main(["import-decisions", store, out]) == 0 and cli.main(["export-reviews", store, f"file://{tmp_path}/copy"]) == 0
    assert [r.action for r in spark.read.json(f"file://{tmp_path}/copy/decisions").collect()] == ["accept"]
    assert cli.main(["inspect-runtime"]) == 0 and json.loads(capsys.readouterr().out)["providers"]["encoder"] == ["hashed-ngrams"]


def test_providers_and_settings(spark):
    from convolens import providers
    from convolens.plans.pipeline import Settings

    encode = providers.make("encoder", "hashed-ngrams", dimensions=16)
    assert len(encode(["x"])[0]) == 16 and providers.names("enricher") == []
    providers.register("enricher", "lengths", lambda: lambda mentions: mentions.select("mention_id", F.length("text").alias("n")))
    df = spark.createDataFrame([("a", "the cat and that of this")], "mention_id string, text string")
    assert providers.make("enricher", "lengths")(df).first().n == 24
    assert df.select(providers.make("language", "hints")(F.col("text")).alias("l")).first().l.language == "en"
    for kind, name in (("encoder", "none"), ("planet", "x")):
        with pytest.raises(ValueError):
            providers.make(kind, name)
    with pytest.raises(ValueError):
        providers.register("planet", "x", dict)
    s = Settings.from_environment({"CONVOLENS_WEIGHTING": "raw", "CONVOLENS_STRICT": "no", "CONVOLENS_ENRICHERS": "lengths, ", "CONVOLENS_NOBODY": "1", "OTHER": "x"})
    assert (s.weighting, s.strict, s.enrichers) == ("raw", False, ("lengths",)) and Settings.from_environment({}) == Settings()


def test_contracts():
    for table in (contracts.METRICS, contracts.REPORTS):
        for name, c in table.items():
            assert c.name == name and callable(c.made_by) and c.counted and inspect.getdoc(c.made_by) is not None or c.made_by.__name__
    assert set(c.family for c in contracts.METRICS.values()) == set(contracts.FAMILY_VERSION) and len(linking.SIGNALS) == 7
