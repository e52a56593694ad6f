"""Encoding of a corpus with a public byte-level BPE vocabulary: every distinct piece is encoded once."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeloom.plans.cut import cut, cut_table, spread

_WHITE = r"\t\n\x0B\f\r \x85\xA0  -     　"
#: The pieces of the vocabulary's splitting rule, written for Java with Unicode white space.
PIECES = rf" ?\p{{L}}++|'s|'t|'re|'ve|'m|'ll|'d| ?\p{{N}}++| ?[^{_WHITE}\p{{L}}\p{{N}}]++|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
#: A piece is frequent if it makes up this share of all pieces and has at most LONG letters; so there are at most 1 / FREQUENT of them.
FREQUENT, LONG = 1 / 100_000, 64

_loaded: dict[str, object] = {}


def vocabulary(path: str | None = None) -> str:
    """Path of a vocabulary of ranks; byte_bpe_50k where none is given."""
    if path:
        return path
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _coder(path: str | None):
    """The coder of a vocabulary, found where this runs; loaded once in each worker."""
    if path not in _loaded:
        import tiktoken

        _loaded[path] = tiktoken.Encoding("own", pat_str=r"(?s:.+)", mergeable_ranks=_ranks(vocabulary(path)), special_tokens={})
    return _loaded[path]


def pieces(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, pieces) of all non-empty texts. Texts with code points that are unassigned to Java are split in Python."""
    docs = spread(documents.where(F.col(text).isNotNull() & (F.col(text) != "")).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers.pre_tokenizers import ByteLevel

        rule = ByteLevel(add_prefix_space=False, use_regex=True)
        for b in batches:
            found = [[t[i:j] for _, (i, j) in rule.pre_tokenize_str(t)] for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, pa.list_(pa.string()))], ["doc_id", "pieces"])

    new = F.col("text").rlike(r"\p{Cn}")
    usual = docs.where(~new).select("doc_id", F.regexp_extract_all("text", F.lit(PIECES), F.lit(0)).alias("pieces"))
    rare = docs.where(new).mapInArrow(split, f"doc_id {kind}, pieces array<string>")
    return usual.unionByName(rare)


def _dictionary(words: DataFrame, path: str | None) -> DataFrame:
    """(piece, n, ids) of each distinct piece."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        for b in batches:
            ids = [coder._encode_single_piece(p.as_py()) for p in b.column("piece")]
            yield pa.RecordBatch.from_arrays([b.column("piece"), b.column("n"), pa.array(ids, pa.list_(pa.int32()))], ["piece", "n", "ids"])

    return words.groupBy("piece").agg(F.count("*").alias("n")).mapInArrow(encode, "piece string, n long, ids array<int>")


def _flat(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """The values of all lists after each other, and where each list begins, with the end."""
    return pc.list_flatten(lists), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)


def _lists(ends: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _expand(values: list, each: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``values[i]`` for every i of ``each`` after each other, and where each begins, with the end."""
    size = np.fromiter(map(len, values), np.int64, len(values))
    flat = np.fromiter((x for v in values for x in v), np.int32, int(size.sum()))
    counts = size[each]
    ends = np.concatenate([[0], np.cumsum(counts)])
    begins = np.cumsum(size) - size
    return flat[np.repeat(begins[each] - ends[:-1], counts) + np.arange(ends[-1])], ends


def encode(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Token ids of every text: (doc_id, ids array<int>), without special tokens.

    Texts are split into pieces once, in order, which are kept in a table; each distinct piece is encoded once. The ids
    of frequent pieces (at most 100,000 by their definition) are put in where the pieces lie, from a broadcast; only
    the other pieces are shuffled, with their positions, joined with their ids and put in at their places. Documents are
    told by a number of their own, so equal ``doc_id`` values don't mix.

    A null text gives null, an empty text an empty list, blank texts the ids of their blanks. Markers that look like
    special tokens are ordinary text. Whole texts are encoded; an empty table gives no rows; other columns are ignored.
    """
    split = cut_table(pieces(documents, doc_id, text).withColumn("row", F.monotonically_increasing_id()))
    known = cut(_dictionary(split.select(F.explode("pieces").alias("piece")), path))
    total = known.agg(F.sum("n")).first()[0] or 0
    hot = (F.col("n") >= max(2.0, total * FREQUENT)) & (F.length("piece") <= LONG)
    often = {r["piece"]: r["ids"] for r in known.where(hot).select("piece", "ids").toLocalIterator()}
    held = documents.sparkSession.sparkContext.broadcast(often)
    kind = split.schema["doc_id"].dataType.simpleString()

    def put_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids with -1 in the place of each piece that isn't frequent, and those pieces."""
        find = held.value.get
        for b in batches:
            flat, at = _flat(b.column("pieces"))
            told = flat.dictionary_encode()
            each = told.indices.to_numpy(zero_copy_only=False)
            found = [find(p) for p in told.dictionary.to_pylist()]
            ids, ends = _expand([(-1,) if f is None else f for f in found], each)
            hole = np.array([f is None for f in found], bool)[each]
            out = [_lists(ends[at], pa.array(ids, pa.int32())), _lists(np.concatenate([[0], np.cumsum(hole)])[at], flat.filter(pa.array(hole, pa.bool_())))]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), *out], ["row", "doc_id", "ids", "holes"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, at = _flat(b.column("ids"))
            ids = flat.to_numpy(zero_copy_only=False)
            fills, into = _flat(pc.list_flatten(b.column("fills")))
            counts = np.ones(len(ids), np.int64)
            counts[ids < 0] = np.diff(into)
            out = np.repeat(ids, counts)
            out[out < 0] = fills.to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(counts)])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), _lists(ends[at], pa.array(out, pa.int32()))], ["doc_id", "ids"])

    begun = cut_table(split.mapInArrow(put_in, f"row long, doc_id {kind}, ids array<int>, holes array<string>"))
    gaps = begun.select("row", F.posexplode("holes").alias("pos", "piece")).join(known.where(~hot).select("piece", F.col("ids").alias("got")), "piece")
    fills = gaps.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "got"))), lambda x: x["got"]).alias("fills"))
    filled = begun.where(F.size("holes") > 0).select("row", "doc_id", "ids").join(fills, "row").select("doc_id", "ids", "fills").mapInArrow(fill, f"doc_id {kind}, ids array<int>")
    rest = documents.where(F.col(text).isNull() | (F.col(text) == "")).select(F.col(doc_id).alias("doc_id"), F.when(F.col(text).isNotNull(), F.array().cast("array<int>")).alias("ids"))
    return begun.where(F.size("holes") == 0).select("doc_id", "ids").unionByName(filled).unionByName(rest)


def token_bytes(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(token, hex) of the vocabulary."""
    return spark.createDataFrame([(i, b.hex()) for b, i in _ranks(vocabulary(path)).items()], "token int, hex string")


def decode(encoded: DataFrame, doc_id: str = "doc_id", ids: str = "ids", path: str | None = None) -> DataFrame:
    """Texts of id lists: (doc_id, text), by a join with the token-byte table (bounded by the vocabulary). Null gives null, an empty list an empty text; an id without bytes gives null."""
    table = F.broadcast(token_bytes(encoded.sparkSession, path))
    long = encoded.where(F.size(F.col(ids)) > 0).select(F.col(doc_id).alias("doc_id"), F.posexplode(ids).alias("pos", "token"))
    joined = long.join(table, "token", "left").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "hex"))).alias("parts"))
    whole = joined.select("doc_id", F.when(~F.exists("parts", lambda p: p["hex"].isNull()), F.decode(F.unhex(F.array_join(F.transform("parts", lambda p: p["hex"]), "")), "UTF-8")).alias("text"))
    rest = encoded.where(F.col(ids).isNull() | (F.size(F.col(ids)) == 0)).select(F.col(doc_id).alias("doc_id"), F.when(F.col(ids).isNotNull(), F.lit("")).alias("text"))
    return whole.unionByName(rest)
