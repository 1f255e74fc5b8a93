"""Decisions of entity resolution on made-up candidates, and merged sources."""

from convolens import plans
from convolens.operators import linking

ALIASES = [
    ("Acorn", "acorn", "acorn", "brand.acorn", "brand", "entity"), ("Acorn X1", "acorn x1", "acornx1", "product.x1", "product", "entity"), ("Birch Mobile", "birch mobile", "birchmobile", "brand.birch", "brand", "entity"),
    ("Warranty", "warranty", "warranty", "concept.warranty", "concept", "concept"), ("Elm River", "elm river", "elmriver", "place.elm1", "location", "entity"), ("Elm River", "elm river", "elmriver", "place.elm2", "location", "entity"),
]
CANDIDATE = "mention_id string, text string, entity_type_hint string, confidence double, methods array<string>, context_text string, full_text string"


def decide(spark, rows, noise=None):
    aliases = spark.createDataFrame(ALIASES, "alias string, normalized string, compact string, canonical_entity_id string, entity_type string, entity_kind string")
    full = [(str(k), text, hint, 0.6, methods, None, None) for k, (text, hint, methods) in enumerate(rows)]
    return {r.mention_id: r for r in linking.decide(spark.createDataFrame(full, CANDIDATE), aliases, noise).collect()}


def test_decisions(spark):
    rows = [
        ("Acorn X1", "product", ["alias_scan"]), ("acornx1", None, ["hashtag"]), ("warranty", None, ["alias_scan"]), ("Elm River", None, ["title_span"]), ("Birch Mobile", "product", ["title_span"]), ("deal", None, ["alias_scan"]),
        ("it", None, ["token_ngram"]), ("Unheard Of Thing", None, ["title_span"]), ("!!", None, ["title_span"]), ("Birch Mobiles", None, ["title_span"]),
    ]
    got = decide(spark, rows, ["deal"])
    assert (got["0"].canonical_entity_id, got["0"].matched_by, got["0"].unresolved_reason) == ("product.x1", "exact_alias", None) and got["0"].link_confidence > 0.9
    assert (got["1"].canonical_entity_id, got["1"].matched_by) == ("product.x1", "compact_alias")
    assert (got["2"].canonical_entity_id, got["2"].concept_entity_id) == (None, "concept.warranty")
    # Equal names of two entities: support by the surface is full, so the first by id is taken.
    assert got["3"].canonical_entity_id == "place.elm1" and got["3"].candidate_ids == ["place.elm1", "place.elm2"]
    assert [got[k].unresolved_reason for k in ("4", "5", "6", "7", "8")] == ["type_conflict", "noise_term", "bad_weak_span", "no_candidate_found", "empty_candidate_text"]
    assert got["9"].candidate_ids == ["brand.birch"]
    assert decide(spark, []) == {}


def test_merge_sources(spark):
    base = [("1", "acorn x1", "acorn x1", 5, 13, "product", 0.9, ["alias_scan"]), ("1", "café", "café", None, None, None, 0.5, ["hashtag"])]
    spans = [("1", "X1", "x1", 11, 13, "product", 0.7, ["ner"]), ("1", "cafe", "cafe", 30, 34, None, 0.6, ["ner"]), ("1", "x1", "x1", 11, 13, "brand", 0.7, ["ner"]), ("2", "other", "other", 0, 5, None, 0.4, ["ner"])]
    got = {(r.mention_id, r.text): (r.start, r.confidence, r.methods) for r in linking.merge_sources(spark.createDataFrame(base, linking.MERGED), spark.createDataFrame(spans, linking.MERGED)).collect()}
    assert got == {("1", "acorn x1"): (5, 0.93, ["alias_scan", "ner"]), ("1", "cafe"): (30, 0.63, ["hashtag", "ner"]), ("1", "x1"): (11, 0.7, ["ner"]), ("2", "other"): (0, 0.4, ["ner"])}


def test_prototype_ranking_sends_no_table_through_the_driver(spark, sf_dir):
    plan = plans.QUERIES["prototype_ranking"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert "Broadcast" not in plan
