"""The ten operators against plain versions, and their edge cases: nulls, empty and long texts, ties, repeated rows,
empty tables, extra columns."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from convolens.llm import bpe, decontamination, html_text, langid, near_copies, pii, quality_rules, queries, quotations, simhash, substring_dedup, token_counts
from convolens.llm.shared import fresh_path

from . import reference_versions as plain

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LIBRARY = pytest.importorskip("tokenizers")


def documents(spark, rows):
    """Documents with columns that operators also make, to clash with them."""
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    return df.withColumns({c: F.lit("x") for c in ("fp", "cell", "pop", "row_key", "words", "content_digest", "ids", "kind", "u", "v", "n_words", "kept")})


@pytest.fixture(scope="module")
def small(sf_dir):
    return duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall()


EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "x" * 200_000), (None, "no id here at all"), (6, "same words again"), (7, "same words again"), (7, "same words again"), (8, " <|endoftext|> 日本 🎉  \r\n\n end ")]


def test_bpe_matches_library(spark, sf_dir, small):
    library = LIBRARY.Tokenizer.from_file(queries.tokenizer_path())
    got = {r.doc_id: r for r in queries.op3_bpe_round_trip(spark, sf_dir).collect()}
    assert len(got) == len(small)
    for i, text in small:
        text = text or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), plain.sha(",".join(map(str, ids))), plain.sha(text))


def test_token_counts_of_all_rows(spark, sf_dir, small):
    library = LIBRARY.Tokenizer.from_file(queries.tokenizer_path())
    want = sorted((i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in small)
    got = queries.op6_token_counts(spark, sf_dir).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    assert sorted(map(tuple, got)) == want


def test_warm_cache_encodes_misses_only(spark, monkeypatch):
    """Texts of known digests neither move nor are encoded again."""
    cache = fresh_path(spark, "cache")
    old = [(k, f"known text number {k}") for k in range(20)]
    token_counts.count_tokens(documents(spark, old), queries.tokenizer_path(), cache)
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(documents(spark, [*old, (99, "a new one")]), queries.tokenizer_path(), cache).collect()}
    library = LIBRARY.Tokenizer.from_file(queries.tokenizer_path())
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in [*old, (99, "a new one")]}
    assert token_counts.read_cache(spark, cache).count() == 21


def test_bpe_hard_texts():
    library, own = LIBRARY.Tokenizer.from_file(queries.tokenizer_path()), bpe.byte_bpe(queries.tokenizer_path())
    rng = random.Random(7)
    texts = ["", " ", "  a", "a\n b", "\n\nx\n", "don't  it's", "<|endoftext|><|endoftext|> x", "a  b", "x" * 5000, "=-" * 999]
    texts += ["".join(rng.choice("abcdetao hsn\n '.,19é$\t🎉本") for _ in range(rng.randint(1, 90))) for _ in range(1500)]
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids
        assert own.decode(ids) == t


def test_bpe_survives_small_tables(monkeypatch):
    own = bpe.ByteBpe(queries.tokenizer_path())
    expect = [own.encode(f"alpha{k} beta{k}\nGamma{k % 7}") for k in range(300)]
    monkeypatch.setattr(bpe, "MEMO_BYTES", 500)
    again = bpe.ByteBpe(queries.tokenizer_path())
    assert [again.encode(f"alpha{k} beta{k}\nGamma{k % 7}") for k in range(300)] == expect


def test_bpe_edges(spark):
    got = bpe.encode_documents(documents(spark, EDGES), queries.tokenizer_path()).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in got) == sorted((i or 0, t or "") for i, t in EDGES)
    assert bpe.encode_documents(documents(spark, []), queries.tokenizer_path()).count() == 0


def test_token_counts_and_cache(spark):
    library = LIBRARY.Tokenizer.from_file(queries.tokenizer_path())
    cache = fresh_path(spark, "cache")
    docs = documents(spark, EDGES)
    for _ in range(2):
        got = token_counts.count_tokens(docs, queries.tokenizer_path(), cache).collect()
        want = sorted((i or 0, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in EDGES)
        assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == want
    stored = token_counts.read_cache(spark, cache)
    assert stored.count() == len({t or "" for _, t in EDGES})
    token_counts.count_tokens(documents(spark, [(1, "one"), (2, "new text")]), queries.tokenizer_path(), cache).collect()
    assert spark.read.parquet(cache).count() == len({t or "" for _, t in EDGES}) + 1
    assert token_counts.count_tokens(documents(spark, []), queries.tokenizer_path(), cache).count() == 0


def test_token_counts_of_other_libraries(spark):
    import sentencepiece

    path = queries.tokenizer_path("piece_bpe_32k.model")
    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = documents(spark, [(1, "Hello  world"), (2, None), (3, "ñandú 日本")])
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, path, fresh_path(spark, "cache")).collect()}
    assert got == {1: len(pieces.encode("Hello  world")), 2: len(pieces.encode("")), 3: len(pieces.encode("ñandú 日本"))}
    path = queries.tokenizer_path("word_bpe_49k.json")
    library = LIBRARY.Tokenizer.from_file(path)
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, path, fresh_path(spark, "cache")).collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in ((1, "Hello  world"), (2, ""), (3, "ñandú 日本"))}


def test_simhash_matches_brute_force(spark, sf_dir, small):
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in queries.op7_simhash_components(spark, sf_dir).collect()}
    prints = {i: plain.simhash(t) for i, t in small}
    roots = plain.components(prints)
    assert got == {i: (prints[i], roots[i]) for i in prints}


def test_simhash_crowded_groups(spark):
    """Many near fingerprints in small tiles give the same components as all pairs."""
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(3)]
    prints = {}
    for i in range(600):
        x = base[i % 3]
        for _ in range(rng.randint(0, 4)):
            x ^= 1 << rng.randrange(64)
        prints[i] = x
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in set(prints.values())], "fp long")
    edges = simhash.links(df, tile=16)
    from convolens.operators.components import connected_components

    roots = {r.node: r.root for r in connected_components(edges).collect()}
    by_root = {}
    for i, r in plain.components(prints).items():
        by_root.setdefault(r, set()).add(signed(prints[i]))
    groups = {}
    for x in {signed(x) for x in prints.values()}:
        groups.setdefault(roots.get(x, x), set()).add(x)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, groups.values()))


def test_simhash_edges(spark):
    got = simhash.near_duplicates(documents(spark, EDGES)).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.fp, r.component_id))
    assert len(got) == len(EDGES)
    assert by[1] == by[2] == by[3] == {(0, 1)}
    assert {c for _, c in by[7]} == {6} and len(by[7]) == 1
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    kept = sorted(r.doc_id for r in near_copies.keep_one(documents(spark, [(3, "a b c d"), (2, "a b c d"), (2, "a b c d"), (9, "quite another text here")])).collect())
    assert kept == [2, 9]


def test_components_of_a_long_chain(spark):
    from convolens.operators.components import connected_components

    df = spark.createDataFrame([(k + 1, k) for k in range(40)] + [(100, 101), (5, 5)], "u long, v long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_substring_dedup_matches_brute_force(spark, sf_dir, small):
    want = {i: (n, g, plain.sha(t)) for i, (n, g, t) in plain.cut_repeats(small).items()}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op10_substring_dedup(spark, sf_dir).collect()}
    assert got == want


def test_substring_dedup_random(spark):
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.choice((0, 5, 19, 20, 21, 60, 150))))) for i in range(60)]
    rows += [(100 + i, " ".join(rng.choice(["p q r s", "t u"]) for _ in range(40))) for i in range(20)]
    want = plain.cut_repeats(rows)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup.repeated_passages(documents(spark, rows), cells=7).collect()}
    assert got == want


def test_substring_dedup_edges(spark):
    passage = " ".join(f"w{k}" for k in range(25))
    rows = EDGES + [(20, passage), (20, passage), (21, "x " + passage), (None, passage)]
    got = substring_dedup.repeated_passages(documents(spark, rows), cells=5).collect()
    assert len(got) == len(rows)
    removed = {}
    for r in got:
        removed.setdefault(r.doc_id, []).append(r.n_removed)
    assert removed[20] == [0, 0] and removed[21] == [25] and sorted(removed[None]) == [0, 25]
    assert [x.asDict() for r in got if r.doc_id == 21 for x in r.removed] == [{"start": 1, "stop": 26}]
    assert substring_dedup.repeated_passages(documents(spark, [])).count() == 0


def test_quality_statistics(spark, sf_dir, small):
    got = {r.doc_id: r for r in queries.op2_quality_rules(spark, sf_dir).collect()}
    assert len(got) == len(small)
    for i, t in small:
        r, want = got[i], plain.base_quality(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def test_quality_rules_learn(spark, sf_dir):
    """On a larger table the list rejects most junk and hardly any good document."""
    folder = sf_dir.replace("sf0.001", "sf0.01")
    judged, rules = quality_rules.judge(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    table = {(r.quality, r.kept): r["count"] for r in judged.join(labels, "doc_id").where(~F.col("base_failed")).groupBy("quality", "kept").count().collect()}
    assert rules.rules and str(rules).endswith("keep")
    assert table.get((1, False), 0) <= 0.01 * table[(1, True)]
    assert table[(0, False)] >= 0.9 * (table[(0, False)] + table.get((0, True), 0))


def test_quality_edges(spark):
    rows = [*EDGES, (30, "a b c d e f g h " * 3), (31, "l\nl\n \nm\nl")]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    judged, rules = quality_rules.judge(documents(spark, rows), labels)
    got = judged.collect()
    assert len(got) == len(rows) and not rules.rules
    by = {r.doc_id: r for r in got}
    for i, t in rows:
        if i is not None:
            assert (by[i].n_words, by[i].word_chars, by[i].n_symbols, by[i].n_dup_lines, by[i].n_repeat_words) == plain.base_quality(t)
    assert quality_rules.judge(documents(spark, []), labels)[0].count() == 0


def test_base_personal_data(spark, sf_dir, small):
    got = {r.doc_id: r for r in queries.op5_personal_data(spark, sf_dir).collect()}
    assert len(got) == len(small)
    for i, t in small:
        assert got[i].base_sha256 == plain.sha(",".join(plain.base_pii(t)))


def test_personal_data_hard_texts(spark):
    rng = random.Random(5)
    texts = ["a@b.com_foo@bar.com", "1.2.3.4.5.6.7.8", "a@b@c.de", "x..@y.z-", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567..", "++12345678901", "256.1.1.1 1.1.1.255", "000255.1.1.1", "ab@c.de ", None, ""]
    texts += ["".join(rng.choice("a1@.+ -(9_%é") for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    texts += ["1" * 100_000, "a" * 100_000 + "@", "1 " * 50_000, "a.b" * 30_000, "+1" * 20_000]
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in pii.base_spans(documents(spark, rows)).select("doc_id", *pii.KINDS).collect()}
    for i, t in rows:
        assert [f"{k}:{s.start}:{s.stop}" for k in pii.KINDS for s in got[i][k]] == plain.base_pii(t), t[:80]


def test_personal_data_bootstrap(spark):
    """Addresses in a known context teach it, and an unseen form in that context is found; ordinary numbers are not."""
    rows = [(i, f"some words reachme: user{i}@mail.example.com thanks a lot") for i in range(30)]
    rows += [(100, "other words reachme: jane(at)corp-7 thanks again"), (101, "chapter 17b of the book, see page 204"), (102, None), (103, "")]
    got = {r.doc_id: r for r in pii.personal_data(documents(spark, rows)).withColumn("digest", pii.digest(F.col("all_spans"))).collect()}
    assert got[100].digest == "email:21:35" and got[101].digest == "" and got[102].digest == ""
    assert got[3].digest == "email:20:42"
    found = pii.personal_data(documents(spark, rows))
    text = {r.doc_id: r.t for r in found.select("doc_id", pii.redact(found).alias("t")).collect()}
    assert text[100] == "other words reachme: [EMAIL] thanks again" and text[101] == rows[31][1]
    assert pii.personal_data(documents(spark, [])).count() == 0


def coverage(doc, item):
    """(tokens under tiles, tokens) of two texts."""
    x, y = decontamination.codes(doc), decontamination.codes(item)
    return decontamination.covered(x, y, decontamination.least_match(len(y))), len(y)


def test_decontamination_tiles():
    item = [f"w{k}" for k in range(40)]
    assert coverage(" ".join(item[20:] + ["x"] + item[:20]).upper(), " ".join(item)) == (40, 40)
    assert coverage(" ".join(item[:10]), " ".join(item)) == (10, 40)
    assert coverage(" ".join(item[:4]), " ".join(item)) == (0, 40)
    assert coverage(None, " ".join(item)) == (0, 40) and coverage("", "too short")[0] == 0 and coverage("a b", "a b") == (0, 2)
    # Fewer tokens than a seed: all of them in a row.
    assert coverage("x who was first there", "Who was first?") == (3, 3) and coverage("who was the first", "Who was first?") == (0, 3)


def test_decontamination_of_repeated_words():
    import time

    for doc, item in ((4_000, 600), (20_000, 600), (20_000, 2_000)):
        start = time.process_time()
        assert coverage("so " * doc, "so " * item) == (item, item)
        assert time.process_time() - start < 5


def test_decontamination_against_naive_tiling():
    rng = random.Random(2)
    for _ in range(150):
        doc, item = [rng.randint(1, 3) for _ in range(rng.randint(5, 30))], [rng.randint(1, 3) for _ in range(rng.randint(5, 20))]
        assert decontamination.greedy_tiles(doc, item, 4) == plain.naive_tiles(doc, item, 4)


def test_decontamination_query_against_naive_tiling(spark, sf_dir):
    """The whole query: every document against every item that shares five tokens in a row with it."""
    rows, items = (duckdb.sql(f"select * from (select {c}, text from '{sf_dir}/{t}.parquet')").fetchall() for t, c in (("documents", "doc_id"), ("benchmark", "item_id")))
    want = plain.contaminated(rows, items)
    got = {(r.doc_id, i) for r in queries.op4_decontamination(spark, sf_dir).collect() for i in r.item_ids}
    assert got == want and len(want) >= 3


def test_decontamination_edges(spark, monkeypatch):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    bench = spark.createDataFrame([(1, passage), (2, None), (3, ""), (4, "short one"), (1, passage)], "item_id long, text string")
    rows = [*EDGES, (40, f"before {passage} after"), (40, f"before {passage} after"), (41, "iota kappa alpha beta gamma"), (42, "Zeta, eta theta; iota kappa -- and then ALPHA beta gamma delta epsilon")]
    docs = documents(spark, rows)
    pairs = decontamination.contaminated(docs, bench)
    assert [(r.doc_id, r.item_ids, r.coverage) for r in decontamination.caught(pairs).orderBy("doc_id").collect()] == [(40, [1], 1.0), (42, [1], 1.0)]
    assert decontamination.clean(docs, pairs).count() == len(rows) - 3
    # A bitmap too small to tell seeds apart only makes more work.
    monkeypatch.setattr(decontamination, "MOST_BITS", 6)
    monkeypatch.setattr(decontamination, "LEAST_BITS", 6)
    assert decontamination.contaminated(docs, bench).count() == 2
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0
    assert decontamination.contaminated(documents(spark, []), bench).count() == 0


def test_html_pages(spark, sf_dir):
    got = queries.op8_html_text(spark, sf_dir).collect()
    pages = dict(duckdb.sql(f"select page_id, html from '{sf_dir}/pages.parquet'").fetchall())
    import html
    import re

    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_html_rules(spark):
    prose = "The quick story of the town is that it was founded by people who came from the coast and stayed for years."
    page = f"""<html><head><title>T</title><script>if (a<b) {{x="</p>"}}</script></head><body><header>Site</header><nav><a href=/>Home</a></nav>
    <div class="cookie-notice">We use cookies.</div><main><h1>A &amp; B</h1><p>{prose}<p>Short.<div class=ad>{prose}</div><p hidden>{prose}</p>
    <ul><li>kept   item</li></ul><ul><li><a href=x>{prose}</a></li></ul><form><p>{prose}</p></form><aside>{prose}</aside><p>1 &lt; 2 &nbsp; 3<!-- <p>no</p> --></p>
    <section id="comments"><p>{prose}</p></section></main><footer>{prose}</footer></body></html>"""
    assert html_text.main_text(page) == f"A & B\n{prose}\nShort.\nkept item\n1 < 2 3"
    loose = f"<div><a href=1>Home</a> <a href=2>News</a></div><h2>Head</h2><div>{prose}</div><div>So it was.</div><div>{prose}</div>"
    assert html_text.main_text(loose) == f"Head\n{prose}\nSo it was.\n{prose}"
    for odd in ("<p title='x", "<", "<<<>>", "<!--", "<script>", "</p></div>", "<a b=\"" * 2000, "<p>" * 20_000):
        html_text.main_text(odd)
    rows = [(1, "u", None), (2, None, ""), (3, "u", page), (3, "u", page)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))).collect()
    assert sorted((r.page_id, r.n_chars) for r in got)[:2] == [(1, 0), (2, 0)] and len(got) == 4
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_language_held_out_accuracy(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    got = queries.op9_language_mixture(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_query_against_plain_mixture(spark, sf_dir, small):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.train(langid.training_rows(docs))
    table = {"".join(chr(c) for c in (code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF) if c): row for code, row in zip(model.codes.tolist(), model.table.tolist(), strict=False)}
    got = {r.doc_id: (r.lang_pred, r.score) for r in queries.op9_language_mixture(spark, sf_dir).collect()}
    assert len(got) == len(small)
    for i, text in small:
        pred, score = plain.mixture(text, table, model.table[-1].tolist(), model.languages, langid.TEMPER)
        assert got[i][0] == pred and abs(got[i][1] - score) < 0.01


def test_language_mixture_and_edges(spark):
    en, de = "the and that with this from there which", "und der die nicht eine werden auch sich"
    train = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate([(en, "en"), (de, "de")] * 30)], "doc_id long, text string, lang string")
    model = langid.train(train)
    rows = [(1, en), (2, f"{en} {de} {en}"), (3, None), (4, "123 !!"), (5, ""), (6, "the " * 50_000), (None, de), (7, "t" * 100_000)]
    got = {r.doc_id: r for r in langid.identify(documents(spark, rows), model).collect()}
    assert (got[1].lang_pred, got[None].lang_pred) == ("en", "de")
    assert set(got[2].languages) == {"en", "de"} and got[2].lang_pred == "en" and 0.5 < got[2].score < 0.8
    assert [got[i].lang_pred for i in (3, 4, 5)] == ["und"] * 3 and got[None].held_out is False
    empty = langid.train(train.limit(0))
    assert {r.lang_pred for r in langid.identify(documents(spark, rows), empty).collect()} == {"und"}
    assert langid.identify(documents(spark, []), model).count() == 0


MESSAGES = "conv_id long, turn long, role string, text string"


def test_quotations(spark):
    rows = [
        (1, 0, "a", "First question about ships.\nSecond line here."),
        (1, 1, "b", "Bob wrote:\n> First  question about SHIPS.\n> second line here.\n\nMy answer is no."),
        (1, 2, "a", "Unrelated remark."),
        (1, 3, "c", "> My answer is no.\n>> First question about ships.\nWhy not?"),
        (1, 4, "a", "> Why not?\nBecause."),
        (2, 0, "x", "> Unrelated remark.\nBorrowed."),
        (2, 1, "x", None),
        (None, 3, "x", "> Why not?"),
        (3, 0, "y", "> never said"),
        (3, 0, "y", "> never said"),
    ]
    df = spark.createDataFrame(rows, MESSAGES).withColumn("digest", F.lit(1)).withColumn("thread", F.lit(2))
    got = quotations.link_quotations(df).collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): r for r in got}
    assert by[1, 1].text == "My answer is no." and (by[1, 1].reply_to, by[1, 1].thread) == (0, 0)
    assert (by[1, 3].reply_to, by[1, 3].thread, by[1, 3].max_level, by[1, 3].n_quotes, by[1, 3].n_linked) == (1, 0, 2, 2, 2)
    assert (by[1, 4].reply_to, by[1, 4].thread) == (3, 0) and by[1, 2].thread == 2
    assert (by[2, 0].linked_conv, by[2, 0].linked_turn, by[2, 0].reply_to) == (1, 2, None)
    assert by[2, 1].text == "" and by[3, 0].n_linked == 0 and by[None, 3].n_linked == 0
    ordered = [r.turn for r in sorted((r for r in got if r.conv_id == 1), key=lambda r: tuple(r[c] for c in quotations.ORDER))]
    assert ordered == [0, 1, 3, 4, 2]
    assert quotations.link_quotations(spark.createDataFrame([], MESSAGES)).count() == 0


def test_quotations_long_chain(spark):
    rows = [(5, k, "u", (f"> message number {k - 1} body\n" if k else "") + f"message number {k} body") for k in range(70)]
    got = {r.turn: (r.reply_to, r.thread) for r in quotations.link_quotations(spark.createDataFrame(rows, MESSAGES)).collect()}
    assert got == {k: (k - 1 if k else None, 0) for k in range(70)}
