"""Exact byte-level BPE encoding by per-prefix dynamic programming, and decoding.

For every prefix of a piece there is exactly one token that can be the last token of
its encoding.  An automaton over the vocabulary yields all tokens that end at each byte;
a token is the last one of its prefix when it is compatible with the last token of the
prefix before it, i.e. when replaying the merges of both never joins them across the
border.  Following the stored tokens back from the end gives the ids.

Pieces are what the vocabulary's pre-tokenizer cuts; their encodings are memoised per
worker in a bounded table, so a repeated piece costs one lookup.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

from pyspark.sql import DataFrame

from .shared import fewer_collections
from .shared import texts as _texts

#: Bytes, as estimated, that a worker's tables of encodings may hold before they are emptied, and entries of the table of
#: token pairs.  Fewer bytes cost time where the vocabulary is large.
MEMO_BYTES = 400_000_000
PAIRS_LIMIT = 400_000
#: Characters of text encoded together; ids and decoded texts of more than these are never held at once.
PORTION = 1_000_000
#: Bytes of a table's slot, its key and tuple without what they hold; a key has up to four bytes a character, a tuple eight an id.
_ENTRY = 200
#: Never a byte of a piece, so matches end at it.
_GAP = "Ā"
_BEGIN = -2


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteBpe:
    """Encoder and decoder for a byte-level BPE ``tokenizer.json`` (see the module text)."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if not is_byte_level(spec):
            raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
        alphabet = byte_alphabet()
        vocab: dict[str, int] = spec["model"]["vocab"]
        to_bytes = lambda token: bytes(alphabet[c] for c in token)
        self.bytes_of: dict[int, bytes] = {i: to_bytes(t) for t, i in vocab.items() if all(c in alphabet for c in t)}
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        # Own numbering: single bytes first, then merge results by the order of their merges.
        self.joined: dict[tuple[int, int], int] = {}
        self.parts: list[tuple[int, int]] = [(b, b) for b in range(256)]
        self.id_of: list[int] = [0] * 256
        rank: dict[str, int] = {}
        for c, b in alphabet.items():
            rank[c], self.id_of[b] = b, vocab[c]
        self.text: list[str] = [chr(b) for b in range(256)]
        for merge in spec["model"]["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair, whole = (rank[left], rank[right]), left + right
            if whole not in rank:
                rank[whole] = len(self.parts)
                self.parts.append(pair)
                self.id_of.append(vocab[whole])
                self.text.append(self.text[pair[0]] + self.text[pair[1]])
            self.joined.setdefault(pair, rank[whole])
        self._fits: dict[int, bool] = {}
        self._widths: list[int] = list(map(len, self.text))
        self._automaton = ahocorasick.Automaton()
        for k, t in enumerate(self.text):
            if k < 256 or self._self_encoding(k):
                self._automaton.add_word(t, (k, len(t)))
        self._automaton.make_automaton()
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self._pieces = regex.compile(pattern).findall
        self._crowded = regex.compile(r"\s\s").search
        self._cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        self._memo: dict[str, tuple[int, ...]] = {}
        self._segments: dict[str, tuple[int, ...]] = {}
        self._memo_bytes = self._segment_bytes = 0
        self.memo_bytes = MEMO_BYTES

    def _self_encoding(self, k: int) -> bool:
        left, right = self.parts[k]
        return self.joined.get((left, right)) == k and self._compatible(left, right, k)

    def _compatible(self, left: int, right: int, below: int = 1 << 31) -> bool:
        """Do ``left`` and ``right`` stay apart?  Undo the later of the two merges and look at the tokens that then
        touch: a merge of those that comes before the undone ones would have joined them first."""
        limit = below
        while True:
            whole = self.joined.get((left, right))
            if whole is not None and whole < limit:
                return False
            if left > right:
                # ``left`` was merged later, so its right half faced ``right`` until then.
                if left < 256:
                    return True
                limit = left
                left = self.parts[left][1]
            else:
                if right < 256:
                    if left < 256:
                        return True
                    limit = left
                    left = self.parts[left][1]
                    continue
                limit = right + 1
                right = self.parts[right][0]

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces that the table lacks, all in one run of the automaton."""
        raw = [p.encode("utf-8").decode("latin-1") for p in pieces]
        line = f"{_GAP}{_GAP.join(raw)}"
        last: list[int] = [-1] * len(line)
        begin = 0
        for chars in raw:
            last[begin] = _BEGIN
            begin += len(chars) + 1
        fits, compatible = self._fits, self._compatible
        for end, (token, width) in self._automaton.iter(line):
            if last[end] == -1:
                before = last[end - width]
                if before >= 0:
                    ok = fits.get(before << 20 | token)
                    if ok is None:
                        ok = fits[before << 20 | token] = compatible(before, token)
                    if ok:
                        last[end] = token
                elif before == _BEGIN:
                    last[end] = token
        memo, id_of, widths = self._memo, self.id_of, self._widths
        at, held = len(line) - 1, 0
        for piece in reversed(pieces):
            out: list[int] = []
            while (token := last[at]) >= 0:
                out.append(id_of[token])
                at -= widths[token]
            at -= 1
            memo[piece] = tuple(out[::-1])
            held += _ENTRY + 4 * len(piece) + 8 * len(out)
        self._memo_bytes += held

    def _of_pieces(self, pieces: list[str]) -> list[int]:
        memo = self._memo
        missing = [p for p in dict.fromkeys(pieces) if p not in memo]
        if missing:
            self._learn(missing)
        return list(chain.from_iterable(map(memo.__getitem__, pieces)))

    def _segment_misses(self, segments: list[str]) -> None:
        known = self._segments
        missing = [s for s in dict.fromkeys(segments) if s not in known]
        if not missing:
            return
        cut = [self._pieces(s if s[0] == "\n" else " " + s) for s in missing]
        memo = self._memo
        if new := [p for p in dict.fromkeys(chain.from_iterable(cut)) if p not in memo]:
            self._learn(new)
        held = 0
        for s, pieces in zip(missing, cut, strict=True):
            ids = known[s] = memo[pieces[0]] if len(pieces) == 1 else tuple(chain.from_iterable(map(memo.__getitem__, pieces)))
            held += _ENTRY + 4 * len(s) + 8 * len(ids)
        self._segment_bytes += held

    def _plain(self, text: str) -> list[int]:
        """Ids of a text without special tokens.

        Where no two white-space characters touch, every space starts a piece and every line feed is one, so the
        text can be cut there first and whole words looked up."""
        if not text:
            return []
        if self._crowded(text) or text[0] in " \n" or text[-1] in " \n":
            return self._of_pieces(self._pieces(text))
        first, *rest = text.replace("\n", " \n").split(" ")
        ids = self._of_pieces(self._pieces(first))
        if rest:
            try:
                ids.extend(chain.from_iterable(map(self._segments.__getitem__, rest)))
            except KeyError:
                self._segment_misses(rest)
                del ids[:]
                ids = self._of_pieces(self._pieces(first))
                ids.extend(chain.from_iterable(map(self._segments.__getitem__, rest)))
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of the whole text; strings of added tokens become those tokens, as the library does."""
        # Tables are only emptied between texts, so that what one text has learned stays until it is done.
        if self._memo_bytes + self._segment_bytes > self.memo_bytes:
            self._memo.clear()
            self._segments.clear()
            self._memo_bytes = self._segment_bytes = 0
        if len(self._fits) > PAIRS_LIMIT:
            self._fits.clear()
        if self._cut is None or not any(s in text for s in self.special):
            return self._plain(text)
        ids: list[int] = []
        for part in self._cut(text):
            if part in self.special:
                ids.append(self.special[part])
            else:
                ids.extend(self._plain(part))
        return ids

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")


def is_byte_level(spec: dict) -> bool:
    """Is this a byte-level BPE with the common pre-tokenizer and nothing that rewrites the text?"""
    cut = spec.get("pre_tokenizer") or {}
    model = spec.get("model", {})
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    added = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in spec.get("added_tokens", []))
    return model.get("type") == "BPE" and plain and added and not spec.get("normalizer") and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")


def portions(batches: Iterable, column: int = 1) -> Iterator:
    """The same rows in slices of about ``PORTION`` bytes of text, one row at least."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        at = held = 0
        for k, n in enumerate(sizes):
            if k > at and held + n > PORTION:
                yield batch.slice(at, k - at)
                at, held = k, 0
            held += n
        if at < len(sizes):
            yield batch.slice(at)


_loaded: dict[str, ByteBpe] = {}


def byte_bpe(path: str) -> ByteBpe:
    """The encoder of ``path``, built once in each worker process."""
    if path not in _loaded:
        fewer_collections()
        _loaded.clear()
        _loaded[path] = ByteBpe(path)
    return _loaded[path]


def encode_documents(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", decode: bool = True, memo_bytes: int = MEMO_BYTES) -> DataFrame:
    """(doc_id long, ids array<int>, decoded string) of every row of ``docs``.

    Null texts count as empty: no ids, empty decoded text.  Every input row gives one row, repeated rows and null
    ids included; other columns are ignored.  Lone surrogates can't occur in Spark strings.  ``memo_bytes`` bounds what a worker
    remembers.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bpe = byte_bpe(path)
        bpe.memo_bytes = memo_bytes
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
        for batch in portions(batches):
            flat, edges, decoded = array("i"), [0], []
            for text in batch.column(1):
                ids = bpe.encode(text.as_py())
                flat.extend(ids)
                edges.append(len(flat))
                decoded.append(bpe.decode(ids) if decode else None)
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.Array.from_buffers(pa.int32(), len(flat), [None, pa.py_buffer(flat)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(decoded, pa.string())], schema=schema)

    return _texts(docs, id_col=id_col, text_col=text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def round_trip_digest(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of the ids and of the text decoded from them, taken where
    the ids are made so that neither leaves the worker."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bpe = byte_bpe(path)
        schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
        shown = {i: str(i) for i in bpe.bytes_of}
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for text in batch.column(1):
                ids = bpe.encode(text.as_py())
                counts.append(len(ids))
                of_ids.append(sha(",".join(map(shown.__getitem__, ids)).encode()))
                of_text.append(sha(bpe.decode(ids).encode()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], schema=schema)

    return _texts(docs, id_col=id_col, text_col=text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
