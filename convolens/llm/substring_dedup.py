"""Exact repeated-passage removal with fixed-block anchors.

A passage of ``WINDOW`` words that repeats holds, wherever it starts, one whole block of ``BLOCK`` words of the
reference text's fixed grid.  So the grid's blocks are indexed, every rolling window of ``BLOCK`` words probes them,
and each hit is extended: all windows of ``WINDOW`` words around it are compared by their whole word sequence, and
runs of repeated windows make up the maximal repeats.

Documents are dealt to cells by id.  A cell sends each different hash once, however often it holds it, so a group of
copies costs a bucket of the index one entry a cell.  Buckets answer to cells with the hashes that matter; three
passes over the text (probe, extend, cut) need no table in one place and no pairs of occurrences.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, settle, size_in_bytes, texts

WINDOW = 20
BLOCK = WINDOW // 2
#: Bytes of input (as Spark estimates them) for a cell and for a bucket of the index.
CELL_BYTES = 4 << 20
LEAST_CELLS = 128
#: An estimate above this means that Spark knows no size; the rows are written once to get one.
UNKNOWN_BYTES = 1 << 60

_A, _B = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_NO_ID = (1 << 63) - 1
_WIRE = "to long, kind int, cell long, one binary, two binary, three binary, four binary"


#: Bytes of text whose words are hashed together.
PORTION = 1 << 20
#: Odd numbers: the base of word hashes and its inverse modulo 2^64.
_R = 0xD1342543DE82EF95
_R_INVERSE = pow(_R, -1, 1 << 64)


def _mix(h):
    import numpy as np

    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _at(w, places, base: int, width: int):
    """Polynomial hash of the ``width`` values from each place on."""
    import numpy as np

    out = w[places]
    for k in range(1, width):
        out *= np.uint64(base)
        out += w[places + k]
    return out


def _powers(base: int, n: int):
    import numpy as np

    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Words:
    """64-bit hashes of words, for many texts at once: sums of byte values times powers of the base, taken between a word's borders and
    divided by the power at its start."""

    def __init__(self):
        import numpy as np

        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.value = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_A))
        self.up, self.down = _powers(_R, PORTION + 2), _powers(_R_INVERSE, PORTION + 2)

    def of(self, raw: bytes):
        """(hashes, places of the first bytes) of the words of ``raw``, which begins and ends with white space."""
        import numpy as np

        bytes_ = np.frombuffer(raw, np.uint8)
        n = len(bytes_)
        if n > len(self.up):
            self.up, self.down = _powers(_R, n), _powers(_R_INVERSE, n)
        space = self.space[bytes_]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        start, stop = edge[::2], edge[1::2]
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.value[bytes_] * self.up[:n], out=total[1:])
        h = (total[stop] - total[start]) * self.down[start]
        return _mix(h ^ ((stop - start).astype(np.uint64) * np.uint64(_B))), start


def _portions(texts: list[bytes]):
    """(first text, bytes with white space around each text, where each text begins) of about ``PORTION`` bytes, one text at least."""
    at = 0
    while at < len(texts):
        size, stop = 0, at
        while stop < len(texts) and (stop == at or size + len(texts[stop]) < PORTION):
            size += len(texts[stop]) + 1
            stop += 1
        yield at, b" " + b" ".join(texts[at:stop]) + b" "
        at = stop


class _Cell:
    """Word hashes of a cell's documents, one after another, and where each document's begin."""

    def __init__(self, table, window: int, block: int):
        import numpy as np

        self.window, self.block = window, block
        self.ids = [(_NO_ID if x is None else x) for x in table.column("doc_id").to_pylist()]
        self.texts = [t.as_py().encode() for t in table.column("text")]
        maker = _Words()
        hashes, counts = [np.empty(0, np.uint64)], np.zeros(len(self.texts), np.int64)
        for first, raw in _portions(self.texts):
            h, start = maker.of(raw)
            hashes.append(h)
            sizes = []
            size = 0
            while size < len(raw) - 1:
                sizes.append(len(self.texts[first + len(sizes)]))
                size += sizes[-1] + 1
            begins = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64) + 1)])
            counts[first : first + len(sizes)] = np.diff(np.searchsorted(start, begins + 1))
        self.w = np.concatenate(hashes)
        self.counts = counts
        self.begin = np.concatenate([[0], np.cumsum(counts)])
        self.doc = np.repeat(np.arange(len(counts)), counts)
        self.place = np.arange(len(self.w)) - self.begin[self.doc] if len(self.w) else np.empty(0, np.int64)
        left = counts[self.doc] - self.place if len(self.w) else self.place
        #: Words from which a block and a window begin inside one document that is long enough for a window.
        self.blocks = np.flatnonzero((left >= block) & (counts[self.doc] >= window)) if len(self.w) else self.place
        self.windows = np.flatnonzero(left >= window)
        self.gram = _at(self.w, self.blocks, _A, block)

    def probes(self):
        """(hash, is in the grid, occurs twice or more here) of the different rolling windows."""
        import numpy as np

        if not len(self.blocks):
            return np.empty(0, np.uint64), np.empty(0, bool), np.empty(0, bool)
        h = _mix(self.gram)
        grid = self.place[self.blocks] % self.block == 0
        order = np.argsort(h)
        h, grid = h[order], grid[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        many = np.diff(np.append(first, len(h))) > 1
        return h[first], np.logical_or.reduceat(grid, first), many

    def candidates(self, hits):
        """Windows around the hits, as arrays (document's index, start, two hashes, is the cell's first of its words), sorted by hash."""
        import numpy as np

        total = np.zeros(len(self.w) + 2, np.int64)
        total[self.blocks + 1] = _member(_mix(self.gram), hits)
        np.cumsum(total, out=total)
        span = self.window - self.block
        at = self.windows[total[self.windows + span + 1] > total[self.windows]]
        if not len(at):
            none = np.empty(0, np.int64)
            return none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool)
        doc, start = self.doc[at], self.place[at]
        one, two = _mix(_at(self.w, at, _A, self.window)), _mix(_at(self.w, at, _B, self.window))
        ids = np.array(self.ids, np.int64)[doc]
        two = two >> np.uint64(32)  # 96 bits of hash tell windows apart
        order = np.lexsort((start, ids, two, one))
        doc, start, one, two, ids = doc[order], start[order], one[order], two[order], ids[order]
        new = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
        group = np.flatnonzero(new)[np.cumsum(new) - 1]
        first = (ids == ids[group]) & (start == start[group])
        return doc, start, one, two, first


def _member(values, table):
    import numpy as np

    if not len(table):
        return np.zeros(len(values), bool)
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return table[at] == values


def _wire(rows: list[tuple]):
    import pyarrow as pa

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    names = ["to", "kind", "cell", "one", "two", "three", "four"]
    cols = list(zip(*rows, strict=True)) if rows else [()] * 7
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)


def _deal(cell: int, bucket, buckets: int, columns: list) -> list[tuple]:
    """One row for each bucket, with its share of each column."""
    import numpy as np

    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    columns = [c[order] for c in columns]
    rows = []
    for b in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
        share = [c[edges[b] : edges[b + 1]].tobytes() for c in columns]
        rows.append((b, 0, cell, *share, *[None] * (4 - len(share))))
    return rows


def _bucket(h, buckets: int):
    import numpy as np

    return ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.int64)


def _gather(table, name: str, dtype):
    import numpy as np

    parts = [np.frombuffer(x.as_buffer(), dtype) for x in table.column(name)]
    return (np.concatenate(parts) if parts else np.empty(0, dtype)), np.array([len(p) for p in parts], np.int64)


def repeated_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, cells: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, removed) for every row of ``docs``.

    A word is removed when a window of ``window`` words that covers it has a word sequence that also starts earlier:
    in a smaller doc_id, or earlier in the same document.  ``kept`` is the remaining words joined by one space and
    ``removed`` the runs of removed words as array<struct<start, stop>>.  Null texts have no words.  Repeated rows of
    one document are the same place of the corpus, so they get equal results and don't remove each other; rows
    without an id come after all others and count as one document.
    """
    block = window // 2
    rows = texts(docs, id_col=id_col, text_col=text_col)
    if cells is None and size_in_bytes(rows) > UNKNOWN_BYTES:
        rows = settle(rows, "sized_rows")
    n = cells or max(LEAST_CELLS, -(-size_in_bytes(rows) // CELL_BYTES))
    # A partition for each cell, so that a task's share does not grow with the input.
    rows = rows.withColumn("cell", F.pmod(F.xxhash64("doc_id"), F.lit(n))).repartition(n, "cell")

    def probe(key, table):
        import numpy as np

        h, grid, many = _Cell(table, window, block).probes()
        flags = (grid + 2 * many).astype(np.uint8)
        # Only rows that can meet another cell's leave: half of the hash names the bucket and place there.
        return _wire(_deal(key[0].as_py(), _bucket(h, n), n, [h.astype(np.uint32), flags]))

    def match(key, table):
        import numpy as np

        h, sizes = _gather(table, "one", np.uint32)
        flags, _ = _gather(table, "two", np.uint8)
        order = np.argsort(h, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
        count = np.diff(np.append(first, len(h)))
        either = np.bitwise_or.reduceat(flags[order], first)
        good = (either & 1 > 0) & ((count > 1) | (either & 2 > 0))
        hit = np.empty(len(h), bool)
        hit[order] = np.repeat(good, count)
        at = np.concatenate([[0], np.cumsum(sizes)])
        out = []
        for k, cell in enumerate(table.column("cell").to_pylist()):
            mine = h[at[k] : at[k + 1]][hit[at[k] : at[k + 1]]]
            if len(mine):
                out.append((cell, 0, key[0].as_py(), mine.tobytes(), None, None, None))
        return _wire(out)

    def hits_of(cell: _Cell, replies):
        """The cell's own hashes whose bucket and lower half were answered, sorted."""
        import numpy as np

        h, _, _ = cell.probes()
        half = (_bucket(h, n).astype(np.uint64) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
        told = [np.empty(0, np.uint64)]
        for kind, bucket, one in zip(replies.column("kind").to_pylist(), replies.column("cell").to_pylist(), replies.column("one"), strict=True):
            if kind == 0:
                told.append(np.frombuffer(one.as_buffer(), np.uint32).astype(np.uint64) | np.uint64(bucket << 32))
        return h[_member(half, np.sort(np.concatenate(told)))]

    def extend(key, table, replies):
        import numpy as np

        cell = _Cell(table, window, block)
        doc, start, one, two, first = cell.candidates(hits_of(cell, replies))
        doc, start, one, two = doc[first], start[first], one[first], two[first]
        ids = np.array(cell.ids, np.int64)[doc] if len(doc) else np.empty(0, np.int64)
        return _wire(_deal(key[0].as_py(), _bucket(one, n), n, [one, two.astype(np.uint32), ids, start.astype(np.uint32)]))

    def settle_owner(key, table):
        import numpy as np

        one, sizes = _gather(table, "one", np.uint64)
        two, _ = _gather(table, "two", np.uint32)
        ids, _ = _gather(table, "three", np.int64)
        start, _ = _gather(table, "four", np.uint32)
        order = np.lexsort((start, ids, two, one))
        a, b = one[order], two[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        lead = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
        later = np.empty(len(one), bool)
        later[order] = (ids[order] != ids[lead]) | (start[order] != start[lead])
        at = np.concatenate([[0], np.cumsum(sizes)])
        out = []
        for k, cell in enumerate(table.column("cell").to_pylist()):
            pick = slice(at[k], at[k + 1])
            if later[pick].any():
                out.append((cell, 1, key[0].as_py(), one[pick][later[pick]].tobytes(), two[pick][later[pick]].tobytes(), None, None))
        return _wire(out)

    def cut(key, table, replies):
        import numpy as np
        import pyarrow as pa

        cell = _Cell(table, window, block)
        doc, start, one, two, first = cell.candidates(hits_of(cell, replies))
        told = [(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint32)) for kind, a, b in zip(replies.column("kind").to_pylist(), replies.column("one"), replies.column("two"), strict=True) if kind == 1]
        elsewhere = np.zeros(len(doc), bool)
        if told:
            a, b = (np.concatenate(x) for x in zip(*told, strict=True))
            pair = np.dtype([("a", np.uint64), ("b", np.uint32)])
            mine, other = np.empty(len(one), pair), np.empty(len(a), pair)
            mine["a"], mine["b"], other["a"], other["b"] = one, two.astype(np.uint32), a, b
            elsewhere = np.isin(mine, other)
        drop = ~first | elsewhere
        by = np.argsort(doc[drop], kind="stable")
        doc, start = doc[drop][by], start[drop][by]
        edges = np.searchsorted(doc, np.arange(len(cell.ids) + 1))
        gone, kept, runs = [], [], []
        for k, text in enumerate(cell.texts):
            words = text.split()
            at = start[edges[k] : edges[k + 1]]
            if not len(at):
                gone.append(0)
                kept.append(b" ".join(words).decode())
                runs.append([])
                continue
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + window, -1)
            out = np.cumsum(edge[:-1]) > 0
            gone.append(int(out.sum()))
            kept.append(b" ".join([words[i] for i in np.flatnonzero(~out).tolist()]).decode())
            turn = np.flatnonzero(np.diff(np.concatenate([[0], out.astype(np.int8), [0]]))).tolist()
            runs.append([{"start": s, "stop": e} for s, e in zip(turn[::2], turn[1::2], strict=True)])
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        return pa.Table.from_arrays(
            [table.column("doc_id"), pa.array(cell.counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()), pa.array(runs, span)],
            names=["doc_id", "n_words", "n_removed", "kept", "removed"],
        )

    spark = docs.sparkSession
    hits = rows.groupBy("cell").applyInArrow(probe, _WIRE).groupBy("to").applyInArrow(match, _WIRE)
    hits = settle(hits, "anchor_hits")
    owners = rows.groupBy("cell").cogroup(hits.groupBy("to")).applyInArrow(extend, _WIRE).groupBy("to").applyInArrow(settle_owner, _WIRE)
    owners = settle(owners, "later_windows")
    replies = hits.unionByName(owners)
    return rows.groupBy("cell").cogroup(replies.groupBy("to")).applyInArrow(cut, "doc_id long, n_words long, n_removed long, kept string, removed array<struct<start: long, stop: long>>")


