"""End-to-end fixture and unit tests of operators that no SQL oracle covers."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from convolens.functions import text as x
from convolens.operators import dedup, entities, language, ontology, review, rules, semantics, spam, threads, topics, validation, vectors
from convolens.operators.halves import border, is_earlier
from convolens.plans import pipeline
from convolens.sources import records
from convolens.streaming import volume

ONTOLOGY = str(__import__("pathlib").Path(__file__).resolve().parent.parent / "configs" / "demo.yaml")


def record(key, kind="POST", parent=None, root=None, depth=0, text="Acorn delivery is great", **more):
    r = {
        "identity": {"uap_id": key, "origin_id": "o", "task_id": "t", "project_id": "p", "uap_type": kind, "platform": more.pop("platform", "tiktok"), "url": "http://u" if kind == "POST" else None},
        "hierarchy": {"parent_id": parent, "root_id": root or key, "depth": depth},
        "author": {"id": more.pop("author", "a1")},
        "content": {"text": text, "title": more.pop("title", None), "language": more.pop("language", None), "summary_title": "st", "keywords": []},
        "engagement": {"likes": more.pop("likes", 3), "bookmarks": 2},
        "temporal": {"posted_at": more.pop("posted_at", "2024-01-01T10:00:00Z"), "updated_at": ""},
        "extra": {"ignored": True},
    }
    r["identity"] |= more.pop("identity", {})
    return r


GOOD = [
    record("p1"),
    record("c1", "COMMENT", "p1", "p1", 1, "I hate the delivery, it is late! but Birch Mobile is not bad", author="a2", posted_at="2024-01-01T10:05:00Z"),
    record("r1", "REPLY", "c1", "p1", 2, "the service is slow and the phone broken", author="a3", posted_at="2024-01-01T10:06:00Z"),
    record("r2", "REPLY", "gone", "p1", 3, "ok"),
    record("p2", text="rt check https://a.b/c https://d.e/f now", author="a4", posted_at="2024-01-02T10:00:00Z"),
    record("p3", text="the price of the Acorn X1 is too expensive for this and that reason", author="a5", posted_at="2024-01-03T10:00:00Z"),
    record("p4", text="the price of the Acorn X1 is too expensive for this and that reason", author="a6", posted_at="2024-01-03T10:30:00Z"),
    record("p5", text="😀😀😀", author="a6", posted_at=None),
]
BAD = [
    record("b1", depth=1), record("b2", "COMMENT", None, "p1", 1), record("b3", "REPLY", "c1", "p1", 1), record("b4", likes=-1),
    record("b5", identity={"task_id": " "}), record("b6", identity={"uap_type": "STORY"}), record("b7", platform="myspace"),
]


@pytest.fixture(scope="module")
def batch(tmp_path_factory):
    folder = tmp_path_factory.mktemp("batch")
    (folder / "deep").mkdir()
    (folder / "deep" / "a.jsonl").write_text("\n".join(map(json.dumps, GOOD)) + "\n\n  \n")
    with zipfile.ZipFile(folder / "b.zip", "w") as z:
        z.writestr("x/b.jsonl", "﻿" + "\n".join(map(json.dumps, BAD)))
        z.writestr("__MACOSX/x/._b.jsonl", "junk")
    return folder


def test_sources_and_validation(spark, batch):
    lines = records.read_records(spark, str(batch))
    assert lines.count() == len(GOOD) + len(BAD)
    assert records.read_jsonl(spark, str(batch / "deep" / "a.jsonl")).agg(F.max("line_number")).first()[0] == len(GOOD)
    assert records.read_jsonl(spark, str(batch), numbered=False).count() == len(GOOD)
    rows = validation.validated(lines)
    assert validation.report(rows).first().asDict() == {"total_records": 15, "valid_records": 8, "invalid_records": 7}
    errors = {r.error for r in validation.error_items(rows).collect()}
    assert {"POST must have depth 0", "COMMENT needs a parent", "REPLY must have depth 2 or more", "engagement.likes is negative", "identity.task_id is blank", "identity.uap_type is unknown", "identity.platform is unknown"} <= errors
    good = rows.where("valid").select("content.title", "engagement.saves", "temporal.updated_at").first()
    assert (good.title, good.saves, good.updated_at) == ("st", 2, None)
    profile = {r.field: r for r in validation.field_profile(lines).collect()}
    assert profile["content.keywords"].missing_count == 15 and profile["identity.uap_id"].example_values.count("|") == 2
    assert profile["identity.url"].present_count + profile["identity.url"].missing_count == 15
    assert records.inspect(spark, str(batch))["entries"] == 2
    with pytest.raises(Exception):
        validation.read_validated(lines).count()


def test_split_files_are_numbered(spark, tmp_path):
    lines = [json.dumps({"n": k, "pad": "x" * (k % 90)}) if k % 7 else "" for k in range(1, 3001)]
    (tmp_path / "big.jsonl").write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = records.read_jsonl(spark, str(tmp_path / "big.jsonl"))
        got = {r.line_number: json.loads(r.value)["n"] for r in rows.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {k: k for k in range(1, 3001) if k % 7}


def test_deep_records(spark):
    deep = '{"a": {"b": {"c": {"d": {"e": {"f": 1.50, "g": [1, {"h": "x"}]}}}}}, "n": null, "t": true, "o": {}}'
    lines = spark.createDataFrame([("f", 1, deep), ("f", 2, "[1]"), ("f", 3, "{oops"), ("f", 4, None)], "source_path string, line_number long, value string")
    got = {(r.line_number, r.field): r.value for r in validation.flatten(lines).collect()}
    assert got == {(1, "a.b.c.d.e.f"): "1.50", (1, "a.b.c.d.e.g"): '[1,{"h":"x"}]', (1, "n"): None, (1, "t"): "true", (1, "o"): "{}"}


def test_malformed_line(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text(json.dumps(GOOD[0]) + "\n{oops\n")
    lines = records.read_records(spark, str(tmp_path / "m.jsonl"))
    assert validation.report(validation.validated(lines)).first().invalid_records == 1
    with pytest.raises(Exception):
        validation.validated(lines, strict=True).agg(F.count_if("valid")).collect()


def test_pipeline(spark, batch, tmp_path):
    out = str(tmp_path / "out")
    manifest = pipeline.run(spark, str(batch), ONTOLOGY, out)
    assert manifest["records"]["valid_records"] == 8 and len(manifest["marts"]) == 18
    assert manifest["filtered"]["kept"] == manifest["filtered"]["normalized"] == 8 and manifest["filtered"]["filtered_out_records"] == 0
    first = spark.read.parquet(f"{out}/marts/fact_mentions").where("mention_id = 'p1'").first()
    assert (first.source_url, first.summary_title, first.language_provider, first.is_shop_video) == ("http://u", "st", "heuristic", None) and first.updated_at is None
    linked = {(r.mention_id, r.canonical_entity_id) for r in spark.read.parquet(f"{out}/marts/fact_entity_mentions").where("canonical_entity_id is not null").collect()}
    assert {("p1", "brand.acorn"), ("c1", "brand.birch"), ("p3", "product.acorn_x1")} <= linked
    kinds = {r.mention_id: r.dedup_kind for r in spark.read.parquet(f"{out}/marts/fact_mentions").collect()}
    assert kinds["p3"] == kinds["p4"] == "exact" and kinds["p1"] is None
    issues = {(r.mention_id, r.issue_category) for r in spark.read.parquet(f"{out}/marts/fact_issue_signals").collect()}
    assert ("c1", "delivery_problem") in issues and ("r1", "product_defect") in issues
    assert pipeline.load_reports(spark, out)["insight_cards"].count() >= 3
    again = pipeline.run(spark, str(batch), ONTOLOGY, str(tmp_path / "out2"), previous_topics=f"{out}/marts/fact_topic_artifacts")
    assert again["records"] == manifest["records"]
    assert spark.read.parquet(str(tmp_path / "out2/marts/fact_topic_artifacts")).agg(F.min("stability_score")).first()[0] == 1.0
    records.register_tables(spark, {"m": f"{out}/marts/fact_mentions"})
    assert spark.sql("select count(*) from m").first()[0] == 8


def one(spark, expr, **cols):
    names = list(cols)
    return spark.createDataFrame([tuple(cols.values())], ", ".join(f"{n} string" for n in names)).select(expr.alias("v")).first().v


def test_text_functions(spark):
    c = F.col("t")
    assert one(spark, x.processing_text(c, x.hashtags(c)), t="Sooooo gooood!!! @me #red2blue https://x.y 😀 ko") == "Soo good! red 2 blue không"
    assert one(spark, x.compact_text(c), t="Đẹp, quá/ hay_ho!") == "đẹp quá hay ho"
    assert one(spark, x.normalize_alias(c), t="  Acorn-X1 (Pro) ") == "acorn x1 pro"
    assert one(spark, x.repair_mojibake(c), t="café".encode().decode("latin-1")) == "café"
    assert one(spark, x.repair_mojibake(c), t="là â") == "là â"
    assert one(spark, x.fold_accents(c), t="điện Thoại") == "dien Thoai"
    assert one(spark, x.boundary_contains(c, "c++"), t="I use C++ now") and not one(spark, x.boundary_contains(c, "cat"), t="concat")
    assert one(spark, x.emojis(c), t="a😀😀b🚀") == ["😀😀", "🚀"]
    assert one(spark, x.shingles(c), t="a b") == ["a b"] and one(spark, x.shingles(c), t="abc def") == ["abcde", "bcdef"]
    assert one(spark, x.nfkc(c), t="ﬁ①") == "fi1" and one(spark, x.collapse_repeats(c), t="aaab!!!!") == "aab!!"
    assert one(spark, x.fuzzy_ratio(c, F.col("u")), t="kitten", u="sitting") == pytest.approx(61.538, abs=0.01)
    assert one(spark, x.fuzzy_token_set(c, F.col("u")), t="big red car", u="red car") == 100.0
    assert one(spark, x.query_variants(c), t="Đẹp Quá") == ["Đẹp Quá", "đẹp quá", "dep qua", "đẹpquá"]
    assert one(spark, x.phrase_windows(c, 2), t="ab cde") == ["cde", "ab cde"]


def test_language(spark):
    c = F.col("t")
    assert one(spark, language.canonical_label(c), t="__label__JP") == "ja" and one(spark, language.canonical_label(c), t="pt_BR") == "pt"
    assert one(spark, language.script_shares(c), t="日本 ab") == {"zh": 1.0}
    assert one(spark, language.best_hint(c), t="the cat and the dog").language == "en"
    gate = pipeline.Settings().gate
    decide = lambda t: one(spark, gate.decide(c, c, F.lit(None).cast("string")), t=t)
    assert decide("this is the house of that man").language == "en" and decide("").reason == "no_semantic_content"
    assert decide("हिन्दी भाषा में लिखा").supported is False
    flags = language.quality_flags(c, c, c, F.lit(2), F.lit(0), F.lit(True))
    assert one(spark, flags, t="look here") == ["url_heavy"] and one(spark, language.quality_label(flags), t="look here") == "spam_like"


def test_segments_and_polarity(spark):
    parts = semantics.segment("Good phone, but slow. Why?")
    assert [(p[2], p[3], p[4]) for p in parts] == [("Good phone", False, False), ("slow", True, False), ("Why", False, True)]
    df = spark.createDataFrame([("m1", "not good. I love it"), ("m2", "plain words"), ("m3", None)], "mention_id string, raw_text string")
    a = semantics.anchors(df)
    s = {(r.mention_id, r.segment): r.score for r in semantics.segments(a).collect()}
    assert s == {("m1", 0): -0.7, ("m1", 1): 1.0, ("m2", 0): 0.0}
    assert [(r.mention_id, r.sentiment) for r in semantics.mention_sentiment(semantics.segments(a)).collect()] == [("m1", "mixed")]


def test_inherited_targets(spark):
    df = spark.createDataFrame([("p", None, "Acorn phone"), ("c", "p", "I hate it")], "mention_id string, parent_id string, raw_text string")
    targets = spark.createDataFrame([("p", "acorn", "brand.acorn")], "mention_id string, target_text string, target_key string")
    a = semantics.anchors(df, targets)
    got = semantics.target_sentiment(a, semantics.segments(a), semantics.inherited_targets(targets, threads.lineage(df))).collect()
    assert [(r.mention_id, r.target_key, r.sentiment, r.inherited) for r in got] == [("c", "brand.acorn", "negative", True)]


def test_near_duplicates(spark):
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    rows = [("a", base), ("b", base + " more"), ("c", base + " else"), ("d", "nothing like the others at all in any way"), ("e", base), ("f", "x")]
    filler = [(f"z{i}", " ".join(f"w{i}x{j}" for j in range(12))) for i in range(80)]
    for extra in ([], filler):
        df = spark.createDataFrame(rows + extra, "mention_id string, text string").withColumn("depth", F.lit(0))
        got = {r.mention_id: (r.dedup_kind, r.dedup_cluster_size) for r in dedup.annotate(df).collect()}
        assert got["a"] == got["e"] == ("exact", 2) and got["b"] == got["c"] == ("near", 2) and got["d"] == (None, 1)


def test_spam_annotations(spark):
    rows = [(f"m{i}", "bot", "rt buy buy buy buy", 3) for i in range(4)] + [("n", "human", "a calm and ordinary sentence", 0)]
    df = spark.createDataFrame(rows, "mention_id string, author_id string, text string, url_count int").withColumns({"normalized": F.col("text"), "depth": F.lit(0), "posted_at": F.lit("2024-01-01 00:00:00").cast("timestamp")})
    got = {r.mention_id: r for r in spam.annotate(spam.mention_features(dedup.annotate(df))).collect()}
    assert got["m0"].author_suspicious and got["m0"].text_quality_label == "spam_like" and got["m0"].semantic_route_hint == "semantic_lite"
    assert got["n"].quality_weight > 0.8 and not got["n"].author_suspicious and "author_burstiness" not in got["n"].suspicion_reason_codes


def test_halves(spark):
    rows = [("a", 3), ("b", 1), ("c", 1), ("d", 2), ("e", 2), ("f", None)]
    df = spark.createDataFrame(rows, "mention_id string, d int").withColumn("posted_at", F.when(F.col("d").isNotNull(), F.timestamp_seconds(F.col("d"))))
    got = {r.mention_id: r.h for r in df.select("mention_id", is_earlier(border(df)).alias("h")).collect()}
    assert got == {"b": True, "c": True, "d": False, "e": False, "a": False, "f": None}
    assert border(df.limit(0)) is None


def test_lineage_cycle_and_missing_parent(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "gone"), ("d", "c")], "mention_id string, parent_id string")
    got = {(r.mention_id, r.ancestor_id, r.distance) for r in threads.lineage(df).collect()}
    assert {("c", "gone", 1), ("d", "c", 1), ("d", "gone", 2), ("a", "b", 1)} <= got


def test_ontology(spark):
    o = ontology.load(ONTOLOGY)
    assert ontology.integrity_errors(o) == []
    broken = ontology.overlay(o, {"topics": [{"id": "t", "name": "T", "related_entity_ids": ["nope"]}], "noise_terms": [{"term": "x"}]})
    assert ontology.integrity_errors(broken) == ["t: related entity nope is unknown"] and len(broken["noise_terms"]) == 2
    texts = spark.createDataFrame([("Acorn store delivery",), ("hello",)], "text string")
    other = {**o, "domain_id": "other", "entities": [], "topics": [], "activation": {"signals": [{"term": "zebra"}]}}
    assert ontology.choose_domain(texts, [other, o])["domain_id"] == "demo_retail"
    assert ontology.choose_domain(texts, [other, o], "other")["domain_id"] == "other"
    facts = spark.createDataFrame([("brand.acorn",), ("provisional.z",), ("bad",)], "e string")
    assert [r.label for r in ontology.alignment_errors(facts, "e", ["brand.acorn"]).collect()] == ["bad"]


def test_entities(spark):
    o = ontology.load(ONTOLOGY)
    df = spark.createDataFrame([("1", "the acornco guarantee deal"), ("2", "zed phone here"), ("3", "zed phone there"), ("4", "birch")], "mention_id string, raw_text string")
    got = {(r.mention_id, r.text, r.canonical_entity_id, r.concept_entity_id, r.unresolved_reason) for r in entities.link(df, ontology.aliases(spark, o), ontology.noise_terms(o), repeated=True).collect()}
    assert ("1", "acornco", "brand.acorn", None, None) in got and ("1", "guarantee", None, "concept.warranty", None) in got
    assert ("2", "zed phone", None, None, "no_candidate_found") in got
    assert [r.text for r in entities.open_clusters(entities.link(df, ontology.aliases(spark, o), repeated=True)).collect()] == ["zed phone"]


def test_topics(spark):
    o = ontology.load(ONTOLOGY)
    docs = spark.createDataFrame([("1", "fast delivery today", None), ("2", "a good price", []), ("3", "nothing", None)], "mention_id string, text string, entities array<string>")
    got = {r.mention_id: r.topic_key for r in topics.best(topics.assignments(docs, topics.prototypes(spark, o))).collect()}
    assert got == {"1": "topic.delivery", "2": "topic.price"}
    phrases = spark.createDataFrame([("t", "a b", 3.0), ("t", "b a", 2.0), ("t", "c", 1.0)], "topic_key string, phrase string, score double")
    assert [r.phrase for r in topics.select_diverse(phrases).orderBy("place").collect()] == ["a b", "c"]
    now = spark.createDataFrame([("k", ["x", "y"], "s")], "topic_key string, terms array<string>, signature string")
    known = spark.createDataFrame([("term", "x", "e1"), ("term", "y", "e2"), ("key", "k", "e3")], "match string, value string, effective_key string")
    assert topics.lineage(now, known).first().effective_key is None
    assert topics.lineage(now, known.where("value = 'x' or match = 'key'")).first().effective_key == "e1"


def test_review(spark):
    d = spark.createDataFrame(
        [("d1", "s", "global", "*", "accept", 1, None, "apply", "foo", None, None), ("d2", "s", "mention", "m", "reject", 2, None, None, "foo", None, None), ("d3", "u", "global", "*", "accept", 1, None, None, "bar", None, None), ("d4", "u", "global", "*", "terminate", 2, "d3", None, "bar", None, None)],
        "decision_id string, signature string, scope_level string, scope_id string, action string, at int, supersedes string, future_effect string, normalized_text string, problem_class string, project_id string",
    ).withColumn("created_at", F.timestamp_seconds("at"))
    assert sorted(r.decision_id for r in review.in_force(d).collect()) == ["d1", "d2"]
    items = spark.createDataFrame([("s", "m", "r", "p", "x", "foo", "c"), ("s", "n", "r", "p", "x", "foo", "c"), ("u", "n", "r", "p", "x", "bar", "c")], "signature string, mention_id string, root_id string, project_id string, domain_id string, normalized_text string, problem_class string")
    assert {(r.signature, r.mention_id): r.action for r in review.effective(items, d).collect()} == {("s", "m"): "reject", ("s", "n"): "accept", ("u", "n"): None}
    assert [r.signature for r in review.suppress(items, d).collect()] == ["u"]
    assert review.scope_relation({"a": "1"}, {"a": "1", "b": "2"}) == "broader" and review.scope_relation({"a": "1"}, {"a": "2"}) == "disjoint"
    old = [{"key": "x", "value": "e1", "scope": {}}]
    assert [review.reconcile(old, {"key": "x", "value": v, "scope": s}) for v, s in (("e1", {}), ("e1", {"p": "1"}), ("e2", {}), ("e2", {"p": "1"}))] == ["identical", "reject", "replace", "coexist"]
    notes = spark.createDataFrame([("k", "t", "a", "u1"), ("k", "t", "a", "u2"), ("k", "t", "b", "u3"), ("k", "z", "a", "u1")], "kind string, normalized_text string, label string, annotator string")
    assert [(r.normalized_text, r.label) for r in review.promote(notes).collect()] == [("t", "a")]
    facts = spark.createDataFrame([("f1", "k", "m", "t", "old"), ("f2", "k", "n", "q", "old")], "fact_id string, kind string, mention_id string, normalized_text string, label string")
    feedback = spark.createDataFrame([("b1", "k", None, "t", "text", 9), ("b2", "k", "m", None, "exact", 1)], "feedback_id string, kind string, mention_id string, normalized_text string, label string, created_at int")
    assert {r.fact_id: r.label for r in review.match_feedback(facts, feedback).collect()} == {"f1": "exact", "f2": "old"}


def test_upsert_and_text_sink(spark, tmp_path):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 5, "y")], "k string, at int, v string")
    new = spark.createDataFrame([("a", 1, "z"), ("b", 2, "w")], "k string, at int, v string")
    assert {r.k: r.v for r in records.upsert_latest(old, new, ["k"], "at").collect()} == {"a": "z", "b": "y"}
    path = str(tmp_path / "t.txt")
    assert [records.write_text_if_changed(spark, path, t) for t in ("é", "é", "f")] == [True, False, True]


def test_embedding_cache(spark):
    rows = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, None)], "id int, text string")
    got, new = vectors.embed(rows)
    assert got.count() == 3 and new.count() == 2
    again, more = vectors.embed(rows.union(spark.createDataFrame([(4, "c")], "id int, text string")), new)
    assert again.count() == 4 and more.count() == 1


def test_rules(spark):
    assert one(spark, rules.stance(F.col("t"), F.col("t"))["label"], t="why so") == "question"
    df = spark.createDataFrame([("m", "apple apple pear the", ["#Tag"], ["apple"])], "mention_id string, text string, hashtags array<string>, keywords array<string>")
    assert [(r.keyphrase, r.confidence) for r in rules.keyphrases(df).collect()] == [("apple", 0.55), ("pear", 0.42), ("#tag", 0.42)]


def test_streaming_volume(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("u", 0), ("u", 60), ("v", 4000)], "author_id string, s int").select("author_id", F.timestamp_seconds("s").alias("posted_at")).write.parquet(src)
    stream = volume.volume(volume.read_stream(spark, src, "author_id string, posted_at timestamp"), "author_id")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("volume_out").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.author_id, r.mentions) for r in spark.table("volume_out").collect()) == [("u", 2), ("v", 1)]
