"""Alignment of the tokens of two tokenizers over whole texts.

Both tokenizers' ids become Arrow lists. Flattening them gives one row per token
with its text as parent; byte lengths summed up within each text give the byte
at which the token ends; an Acero hash join on (text, end) finds the places at
which a token of either side ends. How often two ids end together over all
texts is counted by an Arrow grouping in each task, and Spark adds the counts.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reefgrid.llm.common import slices, stored

BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"
#: Texts of a slice take about so many bytes; its tokens are joined at once.
SLICE = 1 << 19
#: Stretches of text whose ids a worker remembers before it starts anew.
KNOWN_STRETCHES = 250_000
#: Links of a text list that are grouped at once (a matter of memory only).
GROUPED_LINKS = 1_000_000
#: Up to so many different id pairs (16 bytes each) tasks look counts up in a broadcast table; beyond, by a Spark join.
BROADCAST_PAIRS = 4_000_000

_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links array<long>"
_SCORED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
_KEPT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """The printable letter that a byte-level vocabulary writes for each byte."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printed]
    return {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTokens:
    """Ids of a byte-level vocabulary, whose ids are also the order of its merges.

    Special tokens are not looked for: their strings in a text are plain text.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        letters = _byte_letters()
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        special = {t["content"] for t in described["added_tokens"]}
        vocabulary = {t: i for t, i in described["model"]["vocab"].items() if t not in special}
        ranks = {bytes(map(letters.__getitem__, t)): i for t, i in vocabulary.items()}
        self.encoding = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.lengths[i] = len(token)

    def of(self, texts: list[str]) -> tuple[list[np.ndarray], list[bool]]:
        """Ids of a space and each text; their bytes are always the text's."""
        encode = self.encoding.encode_ordinary
        return [np.array(encode(" " + t), np.int64) for t in texts], [True] * len(texts)


class PieceTokens:
    """Ids of a sentence-piece vocabulary with byte fallback.

    No piece goes on past a run of markers into one, or holds a line end, so
    the stretches in between are encoded by themselves and remembered within a bounded cache.
    """

    _STRETCH = re.compile("▁*[^▁\n]+|▁+|\n")

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        byte = re.compile("<0x([0-9A-F]{2})>")
        self.bytes = [bytes([int(m[1], 16)]) if (m := byte.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.apart = not any(re.search("[^▁]▁|\n", p) for p in pieces)
        self.known: dict[str, bytes] = {}
        self.strange: set[str] = set()  # known ones whose tokens do not spell them

    def _learn(self, stretches: set[str]) -> None:
        # A line end before a stretch takes the marker that the model adds; both are cut off.
        ahead = len(self.model.encode("\n"))
        for stretch, ids in zip(stretches, self.model.encode(["\n" + s for s in stretches], num_threads=1)):
            ids = ids[ahead:]
            if b"".join(map(self.bytes.__getitem__, ids)) != stretch.replace("▁", " ").encode():
                self.strange.add(stretch)
            self.known[stretch] = array("i", ids).tobytes()

    def of(self, texts: list[str]) -> tuple[list[np.ndarray], list[bool]]:
        """Ids of each text, and whether their bytes are those of a space and the text."""
        if not self.apart:
            ids = self.model.encode(texts, num_threads=1)
            same = [b"".join(map(self.bytes.__getitem__, i)) == (" " + t).encode() for i, t in zip(ids, texts)]
            return [np.array(i, np.int64) for i in ids], same
        parts = [self._STRETCH.findall("▁" + t.replace(" ", "▁")) for t in texts]
        wanted = set().union(*parts)
        if len(self.known) + len(wanted) > KNOWN_STRETCHES:
            self.known.clear()
            self.strange.clear()
        self._learn(wanted.difference(self.known))
        ids = [np.frombuffer(b"".join(map(self.known.__getitem__, p)), np.int32) for p in parts]
        return ids, ["▁" not in t and (not self.strange or self.strange.isdisjoint(p)) for t, p in zip(texts, parts)]


@functools.cache
def _tokenizers(first: str, second: str) -> tuple:
    """One pair of tokenizers for all tasks of a worker, and the written forms of their ids."""
    a, b = ByteTokens(first), PieceTokens(second)
    written = [f"{i}{end}" for n, ends in ((len(a.lengths), ",|"), (len(b.lengths), (",", ";", ""))) for end in ends for i in range(n)]
    return a, b, pa.array(written, pa.large_string())


def token_table(ids: list[np.ndarray], lengths: np.ndarray) -> pa.Table:
    """``(doc, end, id, at)`` of every token of the lists: the list it is in, the byte it ends at within it, its place."""
    offsets = np.cumsum([0, *map(len, ids)])
    tokens = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(ids) if ids else np.zeros(0), pa.int64()))
    flat, doc = pc.list_flatten(tokens), pc.list_parent_indices(tokens)
    total = pc.cumulative_sum(pc.take(pa.array(lengths), flat))
    # What all lists before have come to is taken off: the sums start anew with every list.
    before = np.concatenate([[0], total.to_numpy()])[offsets[:-1]]
    end = pc.subtract(total, pc.take(pa.array(before, pa.int64()), doc))
    return pa.table({"doc": doc, "end": end, "id": flat, "at": pa.array(np.arange(len(flat)))})


def _groups(a: np.ndarray, b: np.ndarray, a_doc: np.ndarray, b_doc: np.ndarray, a_closes: np.ndarray, b_closes: np.ndarray,
            n_docs: int, kinds: tuple[int, int], written: pa.Array) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of every document."""
    a_group, b_group = np.cumsum(a_closes) - a_closes, np.cumsum(b_closes) - b_closes
    n = int(a_closes.sum())
    b_before = np.concatenate([[0], np.cumsum(np.bincount(b_group, minlength=n))])
    a_until = np.cumsum(np.bincount(a_group, minlength=n))
    last = np.zeros(len(b), bool)
    last[np.flatnonzero(np.diff(b_doc, append=-1))] = True
    line = np.empty(len(a) + len(b), np.int32)
    line[np.arange(len(a)) + b_before[a_group]] = a + kinds[0] * a_closes
    line[np.arange(len(b)) + a_until[b_group]] = b + 2 * kinds[0] + kinds[1] * (b_closes.astype(np.int32) + last)
    sizes = np.bincount(a_doc, minlength=n_docs) + np.bincount(b_doc, minlength=n_docs)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), written.take(pa.array(line)))
    return pc.binary_join(lists, pa.scalar("", pa.large_string())).to_pylist()


def _align(first: str, second: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_side, b_side, written = _tokenizers(first, second)
        kinds = (len(a_side.lengths), len(b_side.lengths))
        none = np.zeros(0, np.int64)
        for batch in slices(batches, "text", SLICE):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            (a_ids, a_same), (b_ids, b_same) = a_side.of(texts), b_side.of(texts)
            same = [bool(t) and x and y for t, x, y in zip(texts, a_same, b_same)]
            a_ids, b_ids = ([i if s else none for i, s in zip(ids, same)] for ids in (a_ids, b_ids))
            ta, tb = token_table(a_ids, a_side.lengths), token_table(b_ids, b_side.lengths)
            met = ta.join(tb, keys=["doc", "end"], join_type="inner", right_suffix="_b", use_threads=False)
            a, b, a_doc, b_doc = (t.column(c).to_numpy() for c in ("id", "doc") for t in (ta, tb))
            a_at, b_at = met.column("at").to_numpy(), met.column("at_b").to_numpy()
            a_closes, b_closes = np.zeros(len(a), bool), np.zeros(len(b), bool)
            a_closes[a_at] = b_closes[b_at] = True
            names = _groups(a, b, a_doc, b_doc, a_closes, b_closes, len(texts), kinds, written)
            links = a[a_at] * kinds[1] + b[b_at]
            doc = a_doc[a_at]
            if np.any(np.diff(doc) < 0):
                order = np.argsort(doc, kind="stable")
                links, doc = links[order], doc[order]
            per_doc = np.bincount(doc, minlength=len(texts))
            groups = np.bincount(a_doc[a_closes], minlength=len(texts))
            sha = [hashlib.sha256(n.encode()).hexdigest() if s else "" for n, s in zip(names, same)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array([len(i) for i in a_ids], pa.int64()), pa.array([len(i) for i in b_ids], pa.int64()),
                 pa.array(groups, pa.int64()), pa.array(per_doc, pa.int64()), pa.array(sha, pa.string()),
                 pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_doc)]), pa.int32()), pa.array(links, pa.int64()))],
                [*_KEPT, "links"])
    return run


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(link, n)`` of the links of a task, each batch of them grouped."""
    def grouped(parts: list[pa.Array]) -> pa.RecordBatch:
        found = pa.table({"link": pa.chunked_array(parts, pa.int64())}).group_by("link", use_threads=False).aggregate([([], "count_all")])
        return pa.RecordBatch.from_arrays([found.column("link").combine_chunks(), found.column("count_all").combine_chunks()], ["link", "n"])

    parts, held = [], 0
    for batch in batches:
        flat = pc.list_flatten(batch.column(0))
        parts.append(flat)
        held += len(flat)
        if held >= GROUPED_LINKS:
            yield grouped(parts)
            parts, held = [], 0
    if held:
        yield grouped(parts)


def _look_up(table):
    """Documents with the counts of their links, from a broadcast ``(link, n, best)`` sorted by link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        link, n, best = table.value
        for batch in batches:
            column = batch.column(len(_KEPT))
            flat = pc.list_flatten(column).to_numpy()
            at = np.searchsorted(link, flat)
            edges = np.concatenate([[0], np.cumsum(pc.list_value_length(column).to_numpy())])
            sums = [np.diff(np.concatenate([[0], np.cumsum(v[at], dtype=np.int64)])[edges]) for v in (best, n)]
            yield pa.RecordBatch.from_arrays(batch.columns[: len(_KEPT)] + [pa.array(s, pa.int64()) for s in sums], [*_KEPT, "n_best", "count_sum"])
    return run


def align_tokens(documents: DataFrame, byte_path: str | None = None, piece_path: str | None = None,
                 broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """How the tokens of two tokenizers meet in every document row.

    Side A encodes a space and the text, side B the text, to which its model adds
    the space; strings of special tokens are plain text. Bytes at which tokens of
    both sides end cut them into groups; an A and a B token that end together are
    a link. ``n_best`` counts the links whose id pair is linked over all documents
    at least as often as any other pair of its B id, ``count_sum`` adds up how
    often the pairs of the document's links are linked over all documents.

    Null and empty texts, and texts whose tokens do not spell them, have no
    tokens: zeros and an empty ``groups_sha256``. Texts are taken whole, however
    long; repeated rows count and return as often as they occur, a null
    ``doc_id`` stays null. Columns other than ``doc_id`` and ``text`` are
    ignored; an empty table gives no rows.
    """
    spark = documents.sparkSession
    first, second = byte_path or tokenizer_path(BYTE_TOKENIZER), piece_path or tokenizer_path(PIECE_TOKENIZER)
    kinds = PieceTokens(second).lengths.size
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_align(first, second), _ALIGNED)
    aligned = stored(rows.withColumn("row", F.monotonically_increasing_id()), "alignment-links")
    parts = aligned.select("links").mapInArrow(_partial_counts, "link long, n long")
    counts = stored(parts.groupBy("link").agg(F.sum("n").alias("n")), "alignment-counts")
    most = counts.groupBy((F.col("link") % kinds).alias("b")).agg(F.max("n").alias("most"))
    judged = counts.join(most, F.col("link") % kinds == F.col("b")).select("link", "n", (F.col("n") == F.col("most")).alias("best"))
    if counts.count() <= broadcast_pairs:
        known = judged.toArrow().sort_by("link")
        values = tuple(known.column(c).to_numpy() for c in ("link", "n", "best"))
        return aligned.select(*_KEPT, "links").mapInArrow(_look_up(spark.sparkContext.broadcast(values)), _SCORED)
    each = aligned.select("row", F.explode("links").alias("link")).groupBy("row", "link").agg(F.count(F.lit(1)).alias("times"))
    sums = each.join(judged, "link").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    return aligned.select("row", *_KEPT).join(sums, "row", "left").select(
        *_KEPT, F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"))
