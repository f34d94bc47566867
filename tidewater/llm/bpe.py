"""Byte-level BPE over a corpus by a global shuffle of distinct words.

Texts are dealt to blocks of about BLOCK_BYTES, stored in a table that is bucketed by block. Each block explodes its texts to
pre-tokens with their positions and keeps the positions to itself: only its distinct words are shuffled, packed by a hash part of the
vocabulary. A part belongs to one task, which encodes each distinct word of the corpus once, on its first sight. The ids go back to the
blocks that asked, join the block's positions there, and the texts' ids are reassembled in order. The bucketed texts are not
shuffled for that join, and no word is hot: it occurs once per block, however often a text repeats it.

Decoding joins the ids with the token-byte table, which has an entry per token of the vocabulary, never more.

Words are told apart by 128 bits; long ones by a cryptographic digest, as polynomial hashes have known collisions there.

PATTERN is fixed: the splitter works on whole arrays of code points, by runs of the character classes, not by a regular expression. The
classes are those of the tiktoken library itself, asked once per run, as versions of Unicode differ.

Defined cases: a null or empty text has no ids and decodes to no bytes; repeated rows and ids, null ids included, are encoded one by
one; special tokens' strings are ordinary text; very long words and texts are encoded whole; an empty table gives no rows; columns besides
the id and the text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import shared_dir
from tidewater.llm.tokens import mixed, slices

#: Fixed value: the pattern that splits texts before merges. ``_cuts`` implements exactly this one.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Bytes of a block's texts, about (one longer text is a block of its own); of all texts per bucket and part of the vocabulary.
BLOCK_BYTES = 16 << 20
BUCKET_BYTES, PART_BYTES = 64 << 20, 256 << 20
#: Bytes of text that are cut and hashed at once, unless one text is longer.
SLICE = 1 << 19
#: Spark's own limit on buckets.
MOST_BUCKETS = 100_000
#: Words of more bytes are hashed by a digest.
LONG = 256
OTHER, LETTER, NUMBER, SPACE = range(4)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def vocabulary(path: str) -> dict[bytes, int]:
    """Ranks from a file of lines "base64 rank"."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def classes() -> np.ndarray:
    """Class of each code point, by the tiktoken library."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    found = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        probe = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        found[np.frombuffer(bytes(probe.encode_ordinary(every)).decode().encode("utf-32-le"), np.uint32)] = kind
    return found


def pieces(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begins, row) of the pre-tokens of all rows, in bytes; each ends where the next begins."""
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.zeros(len(points) + 1, np.int64)
    np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000), out=place[1:])
    first = np.zeros(len(points) + 1, bool)
    first[np.searchsorted(place, offsets)] = True
    begins = place[np.flatnonzero(_cuts(points, first, kinds[points]))]
    return begins, np.searchsorted(offsets, begins, "right") - 1


def _cuts(points: np.ndarray, first: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where PATTERN's matches begin; first: where rows begin or end."""
    n = len(points)
    cut = first[:n].copy()
    cut[1:] |= kind[1:] != kind[:-1]
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], n)
    run = kind[starts]
    # White space before a word: its last character stands alone, or with the word if it is a space. At the end of a text all stays together.
    white = (run == SPACE) & ~first[ends]
    last = ends[white] - 1
    cut[last] = True
    cut[ends[white][points[last] == 0x20]] = False
    # An apostrophe that begins a match, alone before letters.
    alone = np.flatnonzero((run == OTHER) & (ends - starts == 1) & (points[starts] == 0x27) & cut[starts] & ~first[ends])
    alone = alone[run[np.minimum(alone + 1, len(run) - 1)] == LETTER]
    at = starts[alone]
    padded = np.append(points, [0, 0])
    for tail in CONTRACTIONS:
        fits = np.ones(len(at), bool)
        for k, letter in enumerate(tail):
            # Not beyond the text's end: after its first letter, a letter at a row's begin belongs to another text.
            fits &= (padded[at + 1 + k] == ord(letter)) & ~first[np.minimum(at + 1 + k, n)]
        cut[at[fits] + 1] = False
        after = at[fits] + 1 + len(tail)
        cut[after[after < n]] = True
    return cut


def _powers(n: int, kept: dict = {}) -> tuple[np.ndarray, ...]:  # noqa: B006
    """For each base its powers and its inverse's, 0 to n, modulo 2^64; kept between calls."""
    if len(kept.get(0, (b"",))[0]) <= n:
        grown = []
        for base in (b for one in _BASES for b in (one, pow(one, -1, 1 << 64))):
            steps = np.full(max(n, SLICE) + 1, base, np.uint64)
            steps[0] = 1
            grown.append(np.cumprod(steps))
        kept[0] = tuple(grown)
    return kept[0]


def hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the bytes from each begin to its end."""
    powers = _powers(len(data))
    out = []
    for k in range(2):
        letters = mixed(np.arange(256, dtype=np.uint64), 41 + k)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(letters[data] * powers[2 * k][: len(data)], out=sums[1:])
        out.append(mixed((sums[ends] - sums[begins]) * powers[2 * k + 1][begins] + (ends - begins).astype(np.uint64), 43 + k))
    for i in np.flatnonzero(ends - begins > LONG).tolist():
        digest = hashlib.blake2b(data[begins[i] : ends[i]].tobytes(), digest_size=16).digest()
        out[0][i], out[1][i] = np.frombuffer(digest, np.uint64)
    return out[0], out[1]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of the runs that begin at starts and have these lengths, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


def distinct(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first index of each distinct pair in rising order, number of each pair in that order)."""
    order = np.lexsort((two, one))
    a, b = one[order], two[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    number = np.empty(len(a), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


class Block:
    """The distinct words of a block's texts, in the order of their parts and hashes, and each text's words by number."""

    def __init__(self, texts: pa.Array, kinds: np.ndarray, parts: int) -> None:
        self.slices, one, two, self.words = [], [], [], []
        at = 0
        for row, data, offsets in slices(texts, SLICE):
            begins, rows = pieces(data, offsets, kinds)
            ends = np.append(begins[1:], len(data)) if len(begins) else begins
            # Rows follow each other without gaps, so a row's last piece ends where the next row begins.
            h1, h2 = hashes(data, begins, ends)
            found, number = distinct(h1, h2)
            one.append(h1[found])
            two.append(h2[found])
            size = (ends - begins)[found]
            self.words.append((size, data[ragged(begins[found], size)]))
            self.slices.append((row, len(offsets) - 1, np.bincount(rows, minlength=len(offsets) - 1), (number + at).astype(np.int32)))
            at += len(found)
        one, two = np.concatenate([np.zeros(0, np.uint64), *one]), np.concatenate([np.zeros(0, np.uint64), *two])
        found, number = distinct(one, two)
        part = (two[found] % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        #: Number of each word among the distinct ones, by its number among the slices'.
        self.number = place[number]
        self.found, self.part = found[order], part[order]

    def asked(self) -> Iterator[tuple[int, bytes]]:
        """(part, its words: their number, lengths and bytes)."""
        sizes = np.concatenate([np.zeros(0, np.int64), *[s for s, _ in self.words]])
        data = np.concatenate([np.zeros(0, np.uint8), *[d for _, d in self.words]])
        starts = np.cumsum(sizes) - sizes
        edges = np.append(np.flatnonzero(np.append(True, self.part[1:] != self.part[:-1])), len(self.part)) if len(self.part) else np.zeros(1, int)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            own = self.found[a:b]
            yield int(self.part[a]), packed(sizes[own], data[ragged(starts[own], sizes[own])])


def packed(sizes: np.ndarray, data: np.ndarray) -> bytes:
    """Runs of bytes or ids: their number, the width of lengths and of items, lengths, items; all in as few bytes as the largest needs."""
    least = lambda x: x.astype(np.min_scalar_type(int(x.max())) if len(x) else np.uint8)
    sizes, data = least(sizes), least(data)
    return np.array([len(sizes), sizes.itemsize, data.itemsize], np.uint32).tobytes() + sizes.tobytes() + data.tobytes()


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, items) of what ``packed`` gave."""
    n, wide, item = np.frombuffer(blob, np.uint32, 3).tolist()
    return np.frombuffer(blob[12 : 12 + n * wide], f"u{wide}").astype(np.int64), np.frombuffer(blob[12 + n * wide :], f"u{item}")


def _dealt(docs: DataFrame, key: str, text: str, buckets: int) -> DataFrame:
    """(block, id, text), stored in buckets by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            sizes = batch.column(1).cast(pa.large_string()).fill_null("")
            sizes = np.diff(np.frombuffer(sizes.buffers()[1], np.int64, len(sizes) + 1, 8 * sizes.offset))
            blocks = np.empty(len(sizes), np.int64)
            for i, size in enumerate(sizes.tolist()):
                if held and held + size > BLOCK_BYTES:
                    block, held = block + 1, 0
                held += size
                blocks[i] = block
            yield pa.RecordBatch.from_arrays([pa.array(blocks), batch.column(0), batch.column(1)], ["block", "id", "text"])

    spark, name = docs.sparkSession, f"tidewater_bpe_{uuid.uuid4().hex}"
    blocks = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "block long, id long, text string")
    blocks.write.bucketBy(buckets, "block").option("path", f"{shared_dir(spark)}/{name}").option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def encoded(docs: DataFrame, ranks: dict[bytes, int], key: str = "doc_id", text: str = "text", decode: bool = False) -> DataFrame:
    """One row per document: its id, n_tokens, and ids, as little-endian unsigned 32-bit integers.

    decode: adds decoded as ``decoded`` does, in the same task, so that ids don't pass through a second Python worker.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text).cast("long")).alias("n")).first()["n"] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # No fewer buckets than shuffle partitions, or Spark would deal the texts anew.
    buckets, parts = min(max(least, -(-size // BUCKET_BYTES)), MOST_BUCKETS), max(least, -(-size // PART_BYTES))
    kinds = zlib.compress(classes().tobytes())
    table = _dealt(docs, key, text, buckets)
    back = Bytes(ranks) if decode else None
    lines = b"".join(base64.b64encode(token) + b" %d\n" % rank for token, rank in ranks.items())

    def ask(t: pa.Table) -> pa.Table:
        block = t.column("block")[0].as_py()
        found = list(Block(t.column("text").combine_chunks(), np.frombuffer(zlib.decompress(kinds), np.uint8), parts).asked())
        return pa.table({"part": pa.array([p for p, _ in found], pa.int64()), "block": pa.array([block] * len(found), pa.int64()), "words": pa.array([w for _, w in found], pa.binary())})

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        own = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines())}
        # A word is one match: what it holds is not split again.
        one_word = tiktoken.Encoding("word", pat_str=r"(?s:.+)", mergeable_ranks=own, special_tokens={}).encode_ordinary
        known: dict[bytes, np.ndarray] = {}
        for batch in batches:
            for i in range(len(batch)):
                sizes, data = unpacked(batch.column("words")[i].as_py())
                data, ids, at = data.tobytes(), [], 0
                for n in sizes.tolist():
                    word = data[at : at + n]
                    at += n
                    if (found := known.get(word)) is None:
                        found = known[word] = np.array(one_word(word.decode()), np.uint32)
                    ids.append(found)
                lengths = np.fromiter(map(len, ids), np.int64, len(ids))
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), batch.column("part").slice(i, 1), pa.array([packed(lengths, np.concatenate(ids))], pa.binary())], ["block", "part", "ids"])

    def reassemble(t: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(t.column("text").combine_chunks(), np.frombuffer(zlib.decompress(kinds), np.uint8), parts)
        given = [unpacked(blob) for _, blob in sorted(zip(answers.column("part").to_pylist(), answers.column("ids").to_pylist(), strict=True))]
        lengths = np.concatenate([np.zeros(0, np.int64), *[n for n, _ in given]])
        flat = np.concatenate([np.zeros(0, np.uint32), *[i.astype(np.uint32) for _, i in given]])
        if len(lengths) != len(block.found):
            raise RuntimeError("a block's words and their ids do not match")
        starts = np.cumsum(lengths) - lengths
        out, ids = [], t.column("id").combine_chunks()
        for row, rows, count, number in block.slices:
            word = block.number[number]
            tokens = lengths[word]
            each = np.concatenate([[0], np.cumsum(tokens)])
            edges = each[np.concatenate([[0], np.cumsum(count)])]
            data = flat[ragged(starts[word], tokens)]
            columns = {"id": ids.slice(row, rows), "n_tokens": pa.array(np.diff(edges)), "ids": blobs(4 * edges, data)}
            out.append(pa.RecordBatch.from_pydict(columns | ({"decoded": back.of(data, edges)} if back else {})))
        return pa.Table.from_batches(out)

    asked = table.groupBy("block").applyInArrow(ask, "part long, block long, words binary")
    answers = asked.repartition(parts, "part").mapInArrow(encode, "block long, part long, ids binary")
    found = table.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(reassemble, "id long, n_tokens long, ids binary" + ", decoded binary" * decode)
    return found.withColumnRenamed("id", key)


def blobs(edges: np.ndarray, data: np.ndarray) -> pa.Array:
    """Binary values between the edges (in bytes) of the data."""
    return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


class Bytes:
    """The token-byte table: each id's bytes. As large as the vocabulary."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        by_id = {rank: token for token, rank in ranks.items()}
        tokens = [by_id.get(i, b"") for i in range(max(by_id, default=-1) + 1)]
        self.data, self.lengths = np.frombuffer(b"".join(tokens), np.uint8), np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def of(self, ids: np.ndarray, edges: np.ndarray) -> pa.Array:
        """Bytes of the ids between each two edges."""
        sizes = self.lengths[ids]
        return blobs(np.concatenate([[0], np.cumsum(sizes)])[edges], self.data[ragged(self.starts[ids], sizes)])


def decoded(tokens: DataFrame, ranks: dict[bytes, int], column: str = "ids") -> DataFrame:
    """Adds decoded, the bytes of the ids: a join of each id with the token-byte table."""
    table, kinds = Bytes(ranks), tokens.withColumn("decoded", F.lit(b"")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in runs_of(batch.column(column)):
                part = batch.slice(at, n)
                raw = part.column(column).cast(pa.large_binary()).fill_null(b"")
                edges = np.frombuffer(raw.buffers()[1], np.int64, n + 1, 8 * raw.offset)
                data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]]
                yield pa.RecordBatch.from_arrays([*part.columns, table.of(np.frombuffer(data.tobytes(), np.uint32), (edges - edges[0]) // 4)], [*part.schema.names, "decoded"])

    return tokens.mapInArrow(run, kinds)


def runs_of(column: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """(first row, rows) of runs of about ``most`` bytes."""
    sizes = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        done = sizes[at - 1] if at else 0
        end = max(int(np.searchsorted(sizes, done + most, "right")), at + 1)
        yield at, end - at
        at = end
