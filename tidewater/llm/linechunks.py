"""Removal of line chunks and line runs that repeat across the corpus.

Lines are cut by line breaks. A chunk ends after a line where a rolling hash over the last WINDOW line hashes is a multiple of
DIVISOR; so boundaries depend on nearby lines only and move with them. A line of LONG_LINE words or more is a chunk of its own:
long passages on one line are found whatever stands around them. Chunks of two or more lines with words, or of one long line,
are compared over the whole corpus by hash and length; what repeats is compared byte by byte with the chunk's first occurrence
(smallest doc_id, then position), which stays. All equal later ones are removed.

Runs of lines: from every line with words the shortest run of lines on, and the shortest one back, that has over RUN_WORDS words is a
piece too. These lie within any longer run that begins or ends there, and together cover it; so a repeated run of lines with over
RUN_WORDS words goes whole, wherever its lines are cut into chunks. Runs overlap, so their bytes are not sent: what repeats by hash
is compared by a BLAKE2b digest of 128 bits and by length. Later runs that overlap their own first occurrence stay as it does.

A very common piece is counted by partial sums and its first occurrence is a minimum, so it is never gathered; its rows meet
that single row in a join, which Spark broadcasts if small by measured size, and else splits where it is skewed. Only pieces that
a table of bits over the repeated hashes lets pass are shuffled with bytes or digests.

Defined cases: null texts count as empty and have no chunk; empty lines belong to the chunk or run around them; a text whose chunks
are all removed becomes empty; rows without doc_id are left as they are; of rows that share a doc_id each loses the pieces that it has
itself, by position, length and hash, and equal pieces at the same place of theirs are one occurrence; an empty table gives no rows. ``removed_chunks`` counts the chunks with words none of which is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import written
from tidewater.llm.setsketch import narrowed
from tidewater.llm.tokens import _BASE, _INVERSE, _powers, mixed, slices

WINDOW, DIVISOR = 2, 4
LONG_LINE = 20
#: A repeated run of lines with more words than this goes whole.
RUN_WORDS = 50


def chunks(data: np.ndarray, offsets: np.ndarray, long_line: int = LONG_LINE) -> dict[str, np.ndarray]:
    """All chunks of the texts, in order: row, start and end in data (line breaks included), hash, number of lines, and which may be removed."""
    n = len(data)
    breaks = np.flatnonzero(data == 10) + 1
    filled = np.flatnonzero(np.diff(offsets) > 0)
    starts = np.unique(np.concatenate([offsets[filled], breaks[breaks < n]])).astype(np.int64)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return {"row": none, "start": none, "end": none, "hash": none.astype(np.uint64), "lines": none, "removable": none.astype(bool), "text_end": none, "first": none, "last": none, "line_row": none, "line_start": none, "line_end": none, "line_words": none, "run_first": none, "run_last": none, "run_hash": none.astype(np.uint64), "run_size": none, "line_text_end": none}
    # A break at a text's very end begins no new line.
    ends = np.append(starts[1:], n)
    rows = np.searchsorted(offsets, starts, "right") - 1
    solid = np.ones(256, bool)
    solid[[32, *range(9, 14)]] = False
    inside = solid[data]
    before = np.concatenate([[False], inside[:-1]])
    before[starts] = False
    words = np.concatenate([[0], np.cumsum(inside & ~before)])
    words = words[ends] - words[starts]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(np.arange(256, dtype=np.uint64), 71)[data] * _powers(n, _BASE)[:n], out=sums[1:])

    def ranged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mixed((sums[b] - sums[a]) * _powers(n, _INVERSE)[a] + (b - a).astype(np.uint64))

    # The last line of a text has no break: hashed without it, like any other line.
    text_end = ends - (data[ends - 1] == 10)
    h = ranged(starts, text_end)
    rolled = h.copy()
    first = np.concatenate([[True], rows[1:] != rows[:-1]])
    for back in range(1, WINDOW):
        earlier = np.concatenate([np.zeros(back, np.uint64), h[:-back]])
        near = np.arange(len(h)) - np.maximum.accumulate(np.where(first, np.arange(len(h)), 0)) >= back
        rolled = rolled + np.where(near, earlier * np.uint64(_BASE), np.uint64(0))
    long = words >= long_line
    cut = (mixed(rolled, 3) % np.uint64(DIVISOR) == 0) | long | np.append(first[1:], True)
    cut[:-1] |= long[1:]
    last = np.flatnonzero(cut)
    head = np.concatenate([[0], last[:-1] + 1])
    with_words = np.concatenate([[0], np.cumsum(words > 0)])
    lines = with_words[last + 1] - with_words[head]
    run_first, run_last = _runs(words, rows)
    return {
        "row": rows[head], "start": starts[head], "end": ends[last], "hash": ranged(starts[head], text_end[last]), "lines": lines, "removable": (lines >= 2) | long[head], "text_end": text_end[last],
        "first": head, "last": last, "line_row": rows, "line_start": starts, "line_end": ends, "line_words": words, "line_text_end": text_end,
        # Runs never share a hash with chunks.
        "run_first": run_first, "run_last": run_last, "run_hash": mixed(ranged(starts[run_first], text_end[run_last]), 5), "run_size": text_end[run_last] - starts[run_first],
    }


def _runs(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) lines of the shortest runs with over RUN_WORDS words from each line with words on and back; single lines of that many are chunks."""
    n = len(words)
    upto = np.concatenate([[0], np.cumsum(words)])
    own = np.flatnonzero(words > 0)
    # On: the first line whose end has RUN_WORDS + 1 words more than the start; back: the last line whose start has as many less.
    on = np.searchsorted(upto, upto[own] + RUN_WORDS + 1, "left") - 1
    back = np.searchsorted(upto, upto[own + 1] - RUN_WORDS - 1, "right") - 1
    ok_on, ok_back = on < n, back >= 0
    first, last = np.concatenate([own[ok_on], back[ok_back]]), np.concatenate([on[ok_on], own[ok_back]])
    inside = (rows[first] == rows[last]) & (first < last)
    both = np.unique(np.stack([first[inside], last[inside]], 1), axis=0)
    return both[:, 0], both[:, 1]


def _pieces(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Removable chunks, then runs: row, first and last line counted from the text's first, hash, size and where they begin."""
    ok = np.flatnonzero(c["removable"])
    first, last = np.concatenate([c["first"][ok], c["run_first"]]), np.concatenate([c["last"][ok], c["run_last"]])
    row = c["line_row"][first]
    base = np.searchsorted(c["line_row"], row, "left")
    size = np.concatenate([c["text_end"][ok] - c["start"][ok], c["run_size"]])
    return {"row": row, "line": first - base, "span": last - first + 1, "hash": np.concatenate([c["hash"][ok], c["run_hash"]]).view(np.int64), "size": size, "start": c["line_start"][first], "chunks": len(ok)}


def _listed(batches: Iterator[pa.RecordBatch], with_bytes: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for row, data, offsets in slices(batch.column("text")):
            p = _pieces(chunks(data, offsets))
            if not len(p["row"]):
                continue
            columns, names = [pa.array(p["hash"], pa.int64()), pa.array(p["size"], pa.int64())], ["hash", "size"]
            if with_bytes:
                raw = data.tobytes()
                found = [raw[a : a + b] for a, b in zip(p["start"].tolist(), p["size"].tolist(), strict=True)]
                found[p["chunks"] :] = [hashlib.blake2b(x, digest_size=16).digest() for x in found[p["chunks"] :]]
                columns += [pa.array(ids[row + p["row"]], pa.int64()), pa.array(p["line"], pa.int32()), pa.array(p["span"], pa.int32()), pa.array(found, pa.binary())]
                names += ["doc_id", "line", "span", "bytes"]
            yield pa.RecordBatch.from_arrays(columns, names)


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, line, span, hash): pieces to remove, by their first line and number of lines."""
    slim = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    thin = slim.mapInArrow(lambda b: _listed(b, False), "hash long, size long")
    counts = thin.groupBy("hash", "size").agg(F.count("*").alias("times"))
    again = written(counts.where("times > 1").select("hash", "size"), "chunks-again")
    full = slim.mapInArrow(lambda b: _listed(b, True), "hash long, size long, doc_id long, line int, span int, bytes binary")
    # An inner join, as a semi-join would be pushed below the table of bits; again has each hash and size once.
    full = written(narrowed(full, "hash", again.select("hash")).join(again, ["hash", "size"]), "chunks-full")
    place = F.struct("doc_id", "line")
    firsts = full.groupBy("hash", "size").agg(F.min(place).alias("place"))
    first_bytes = full.select("hash", "size", place.alias("place"), F.col("bytes").alias("first")).join(firsts, ["hash", "size", "place"], "left_semi").dropDuplicates(["hash", "size"])
    apart = (F.col("doc_id") != F.col("place.doc_id")) | (F.col("line") >= F.col("place.line") + F.col("span"))
    gone = full.join(first_bytes, ["hash", "size"]).where((F.col("bytes") == F.col("first")) & apart)
    return gone.select("doc_id", "line", "span", "hash").distinct()


def cleaned(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chunks, removed_chunks, removed_words, text without the removed chunks and runs."""
    gone = repeated(docs).groupBy("doc_id").agg(F.collect_list("line").alias("line"), F.collect_list("span").alias("span"), F.collect_list("hash").alias("hash"))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = {k: batch.column(k) for k in ("line", "span", "hash")}
            for row, data, offsets in slices(batch.column("text")):
                c = chunks(data, offsets)
                n = len(offsets) - 1
                p = _pieces(c)
                upto, line_upto = (np.searchsorted(c[k], np.arange(n + 1), "left") for k in ("row", "line_row"))
                order = np.argsort(p["row"], kind="stable")
                piece_upto = np.searchsorted(p["row"][order], np.arange(n + 1), "left")
                raw = data.tobytes()
                texts, removed, cut_words = [], [], []
                for i in range(n):
                    if not lists["hash"][row + i].is_valid:
                        texts.append(raw[offsets[i] : offsets[i + 1]].decode())
                        removed.append(0), cut_words.append(0)
                        continue
                    line, span, h = (np.asarray(lists[k][row + i].values) for k in ("line", "span", "hash"))
                    mine = order[piece_upto[i] : piece_upto[i + 1]]
                    # A row of the same doc_id with another text may have other pieces there.
                    has = set(zip(p["line"][mine].tolist(), p["span"][mine].tolist(), p["hash"][mine].tolist(), strict=True))
                    true = np.array([x in has for x in zip(line.tolist(), span.tolist(), h.tolist(), strict=True)], bool)
                    line, span = line[true].astype(np.int64), span[true].astype(np.int64)
                    a, b = int(line_upto[i]), int(line_upto[i + 1])
                    steps = np.bincount(line, minlength=b - a + 1) - np.bincount(line + span, minlength=b - a + 1)
                    out = np.cumsum(steps)[: b - a] > 0
                    keep = np.flatnonzero(~out) + a
                    texts.append(b"".join(raw[s:e] for s, e in zip(c["line_start"][keep].tolist(), c["line_end"][keep].tolist(), strict=True)).decode())
                    words = np.where(out, c["line_words"][a:b], 0)
                    heads = c["first"][upto[i] : upto[i + 1]] - a
                    had, lost = np.add.reduceat(c["line_words"][a:b], heads), np.add.reduceat(words, heads)
                    removed.append(int(((lost == had) & (had > 0)).sum())), cut_words.append(int(words.sum()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, n), pa.array(np.diff(upto), pa.int64()), pa.array(removed, pa.int64()), pa.array(cut_words, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "n_chunks", "removed_chunks", "removed_words", "text"])

    # Texts that surely lose nothing are not shuffled for the look-up.
    gone = written(gone, "chunks-gone")
    none = [F.lit(None).cast(gone.schema[c].dataType).alias(c) for c in ("line", "span", "hash")]
    sure = narrowed(slim, "doc_id", gone.select("doc_id"), rest=True).select("doc_id", "text", *none)
    unsure = narrowed(slim, "doc_id", gone.select("doc_id")).join(gone, "doc_id", "left").select("doc_id", "text", "line", "span", "hash")
    return sure.unionByName(unsure).mapInArrow(run, "doc_id long, n_chunks long, removed_chunks long, removed_words long, text string")
