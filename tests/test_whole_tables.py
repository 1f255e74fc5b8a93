"""Queries without SQL that cover their whole table, against plain versions."""

import re

import duckdb

from convolens import plans
from convolens.operators import vectors
from convolens.plans.batch import BRANDS
from convolens.plans.texts import vector_digest


def test_embed_documents(spark, sf_dir):
    rows = duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall()
    encode = vectors.hashed_encoder()
    plain = spark.createDataFrame([(i, encode([t or ""])[0]) for i, t in rows], "id long, vector array<double>")
    want = sorted((r.id, 256, r.vector_sha256) for r in plain.select("id", vector_digest()).collect())
    assert sorted(map(tuple, plans.QUERIES["embed_documents"](spark, sf_dir).collect())) == want
    assert len({r[2] for r in want}) > 1


def brute_force(rows):
    out = set()
    for i, text in rows:
        words = " ".join(re.sub(r"[^\w\s]", " ", (text or "").lower()).split()).split(" ")
        runs = {" ".join(words[k : k + n]) for n in range(1, 6) for k in range(len(words) - n + 1)}
        for k, name in enumerate(BRANDS):
            if any(r.replace(" ", "") == name.lower().replace(" ", "") for r in runs):
                out.add((str(i), f"brand.b{k}"))
    return out


def test_alias_scan_compact(spark, tmp_path):
    texts = ["we saw There Th today", "we saw thereth today", "el le is apart", "KeitEin, twice: keit ein", "nothing here", "The Of", "theof", "other elle", None]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {tuple(r)[:2] for r in plans.QUERIES["alias_scan"](spark, str(tmp_path)).collect()}
    assert got == brute_force(enumerate(texts))
    assert {("1", "brand.b0"), ("6", "brand.b3")} <= got
