"""Domain ontologies: loading, overlays, integrity, choice of the domain, and alias tables."""

from __future__ import annotations

import hashlib
import re
from copy import deepcopy

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPSERTED = ("entities", "aspect_categories", "issue_categories", "topics")
APPENDED = ("alias_contributions", "noise_terms")
LISTS = ("entity_types", "taxonomy_nodes", "intent_categories", "source_channels", *UPSERTED, *APPENDED)


def load(path: str, overlays: tuple[str, ...] = ()) -> dict:
    """A YAML ontology, with overlays applied in order."""
    import yaml

    def read(p: str) -> dict:
        with open(p, encoding="utf-8") as f:
            return yaml.safe_load(f) or {}

    out = read(path)
    for p in overlays:
        out = overlay(out, read(p))
    for name in LISTS:
        out.setdefault(name, [])
    return out


def overlay(base: dict, extra: dict) -> dict:
    """Entities, aspects, issues and topics replace those of the same id or join them; aliases and noise are added."""
    out = deepcopy(base)
    for name in UPSERTED:
        table = {x["id"]: x for x in out.get(name, [])}
        table |= {x["id"]: x for x in extra.get(name, [])}
        out[name] = list(table.values())
    for name in APPENDED:
        out[name] = [*out.get(name, []), *extra.get(name, [])]
    return out


def fingerprint(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()[:16]


def integrity_errors(o: dict) -> list[str]:
    """References that lead nowhere, and ids used twice."""
    ids = {name: [x["id"] for x in o.get(name, [])] for name in ("entities", "aspect_categories", "issue_categories", "topics", "taxonomy_nodes")}
    errors = [f"{name}: {i} is used twice" for name, values in ids.items() for i in sorted({v for v in values if values.count(v) > 1})]
    have = {name: set(values) for name, values in ids.items()}
    types = set(o.get("entity_types", []))

    def need(owner: str, field: str, table: str, values) -> None:
        errors.extend(f"{owner}: {field} {v} is unknown" for v in values or () if v not in have[table])

    for x in o.get("taxonomy_nodes", []):
        need(x["id"], "parent_id", "taxonomy_nodes", [x["parent_id"]] if x.get("parent_id") else ())
    for x in o.get("entities", []):
        need(x["id"], "taxonomy_id", "taxonomy_nodes", x.get("taxonomy_ids"))
        need(x["id"], "neighbor", "entities", x.get("neighbor_entity_ids"))
        if types and x.get("entity_type") not in types:
            errors.append(f"{x['id']}: entity type {x.get('entity_type')} is unknown")
    for x in o.get("aspect_categories", []):
        need(x["id"], "related issue", "issue_categories", x.get("related_issue_ids"))
    for x in o.get("topics", []):
        need(x["id"], "related entity", "entities", x.get("related_entity_ids"))
        need(x["id"], "related aspect", "aspect_categories", x.get("related_aspect_ids"))
        need(x["id"], "related issue", "issue_categories", x.get("related_issue_ids"))
    for x in o.get("alias_contributions", []):
        need(x.get("alias", "?"), "entity", "entities", [x["canonical_entity_id"]])
    return errors


def normalize(text: str) -> str:
    return " ".join(re.sub(r"[^\w\s]", " ", text.lower()).split())


def aliases(spark: SparkSession, o: dict, context: dict[str, str] | None = None) -> DataFrame:
    """(alias, normalized, compact, canonical_entity_id, entity_type, entity_kind) of linkable entities; contributions
    whose constraints the context doesn't meet stay out."""
    rows = []
    kinds = {x["id"]: x for x in o["entities"]}
    named = [(a, x["id"]) for x in o["entities"] if x.get("active_linking", True) for a in (x["name"], *x.get("aliases", ()), *x.get("compact_aliases", ()))]
    named += [(c["alias"], c["canonical_entity_id"]) for c in o["alias_contributions"] if applies(c.get("scope", {}), context or {})]
    for alias, entity in dict.fromkeys(named):
        x = kinds[entity]
        rows.append((alias, normalize(alias), normalize(alias).replace(" ", ""), entity, x.get("entity_type"), x.get("entity_kind", "entity")))
    return spark.createDataFrame(rows, "alias string, normalized string, compact string, canonical_entity_id string, entity_type string, entity_kind string").where("normalized <> ''")


def applies(constraints: dict, context: dict) -> bool:
    """A missing constraint admits everything."""
    return all(v is None or context.get(k) == v for k, v in constraints.items())


def noise_terms(o: dict, context: dict[str, str] | None = None) -> list[str]:
    return sorted({normalize(x["term"]) for x in o["noise_terms"] if applies(x.get("scope", {}), context or {})})


def other_domain_aliases(mine: DataFrame, others: DataFrame) -> DataFrame:
    """Aliases that only other domains use."""
    return others.select("normalized").distinct().join(mine.select("normalized").distinct(), "normalized", "left_anti")


def domain_terms(o: dict) -> dict[str, float]:
    """Terms that speak for a domain: activation signals, aliases (more with a digit), topic names and phrases."""
    out: dict[str, float] = {}
    give = lambda term, w: out.__setitem__(term, max(w, out.get(term, 0.0))) if term else None
    for s in o.get("activation", {}).get("signals", []):
        give(s["term"].lower(), float(s.get("weight", 1.0)))
    for x in o["entities"]:
        for a in (x["name"], *x.get("aliases", ())):
            give(a.lower(), 1.3 if any(c.isdigit() for c in a) else 1.0)
    for t in o["topics"]:
        give(t["name"].lower(), 0.9)
        for p in t.get("seed_phrases", ()):
            give(p.lower(), 0.6)
    return out


def domain_scores(texts: DataFrame, domains: list[dict]) -> DataFrame:
    """(domain_id, score, matched_records): each term counts once a record."""
    out = None
    low = F.lower("text")
    for o in domains:
        terms = domain_terms(o)
        found = [F.when(low.contains(t), F.lit(w)).otherwise(F.lit(0.0)) for t, w in terms.items()]
        per = sum(found, F.lit(0.0))
        row = texts.agg(F.lit(o["domain_id"]).alias("domain_id"), F.coalesce(F.sum(per), F.lit(0.0)).alias("score"), F.count_if(per > 0).alias("matched_records"))
        out = row if out is None else out.unionByName(row)
    return out


def choose_domain(texts: DataFrame, domains: list[dict], explicit: str | None = None, least_score: float = 1.0) -> dict:
    """The named domain, else the best scored one, else the first."""
    by_id = {o["domain_id"]: o for o in domains}
    if explicit:
        return by_id[explicit]
    best = domain_scores(texts, domains).orderBy(F.desc("score"), F.desc("matched_records"), "domain_id").first()
    return by_id[best["domain_id"]] if best["score"] >= least_score else domains[0]


def alignment_errors(facts: DataFrame, column: str, known: list[str], prefix: str = "provisional.") -> DataFrame:
    """Distinct labels that the ontology lacks; provisional ones are allowed."""
    labels = facts.where(F.col(column).isNotNull()).select(F.col(column).alias("label")).distinct()
    return labels.where(~F.col("label").isin(*known) & ~F.col("label").startswith(prefix))


def dimension_tables(spark: SparkSession, o: dict) -> dict[str, DataFrame]:
    entity = [(x["id"], x["name"], x.get("entity_type"), x.get("entity_kind", "entity"), x.get("active_linking", True), x.get("taxonomy_ids", [])) for x in o["entities"]]
    nodes = [(x["id"], x["name"], x.get("parent_id")) for x in o["taxonomy_nodes"]]
    sources = [(x["id"], x.get("name")) for x in o["source_channels"]]
    return {
        "dim_entities": spark.createDataFrame(entity, "canonical_entity_id string, entity_name string, entity_type string, entity_kind string, active_linking boolean, taxonomy_ids array<string>"),
        "dim_taxonomy": spark.createDataFrame(nodes, "node_id string, name string, parent_id string"),
        "dim_sources": spark.createDataFrame(sources, "channel_id string, name string"),
    }


def prototype_texts(o: dict, entity_id: str) -> dict[str, list[str]]:
    """Texts that stand for an entity, by kind: its own names; names of its neighbours; and labels and phrases of the topics that name it,
    with the aspects and issues these lead to.  Each text once, under the first kind that has it."""
    by = {name: {x["id"]: x for x in o.get(name, [])} for name in ("entities", "aspect_categories", "issue_categories", "topics")}
    own = by["entities"][entity_id]
    topics = [t for t in o.get("topics", []) if entity_id in t.get("related_entity_ids", ())]
    aspects = [by["aspect_categories"][i] for t in topics for i in t.get("related_aspect_ids", ()) if i in by["aspect_categories"]]
    issues = [i for x in (*topics, *aspects) for i in x.get("related_issue_ids", ())]
    names = lambda x: [x["name"], *x.get("aliases", ()), *x.get("compact_aliases", ())]
    found = {
        "name": names(own), "neighbor": [by["entities"][i]["name"] for i in own.get("neighbor_entity_ids", ()) if i in by["entities"]], "aspect": [x["name"] for x in aspects],
        "issue": [by["issue_categories"][i]["name"] for i in issues if i in by["issue_categories"]], "topic": [t["name"] for t in topics],
        "phrase": [p for x in (*topics, *aspects) for p in x.get("seed_phrases", ())],
    }
    seen: set[str] = set()
    out: dict[str, list[str]] = {}
    for kind, texts in found.items():
        kept = []
        for text in texts:
            key = normalize(text)
            if key and key not in seen:
                seen.add(key)
                kept.append(text)
        out[kind] = kept
    return out


def prototype_table(spark: SparkSession, o: dict) -> DataFrame:
    """(canonical_entity_id, kind, place, text) of all entities."""
    rows = [(x["id"], kind, k, text) for x in o["entities"] for kind, texts in prototype_texts(o, x["id"]).items() for k, text in enumerate(texts)]
    return spark.createDataFrame(rows, "canonical_entity_id string, kind string, place int, text string")


def phrase_lexicon(o: dict) -> list[str]:
    """All names and seed phrases of two words or more, normalised and sorted: what segmentation keeps together."""
    texts = [n for x in o["entities"] for n in (x["name"], *x.get("aliases", ()))]
    texts += [p for name in ("aspect_categories", "issue_categories", "topics") for x in o.get(name, []) for p in (x["name"], *x.get("seed_phrases", ()))]
    return sorted({n for n in map(normalize, texts) if " " in n})
