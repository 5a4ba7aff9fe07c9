"""Token counts from flat token files by a separator scan.

A flat file is a run of token identifiers of fixed width, each document followed by an
end-of-document identifier, with no index. Files are read as blocks; a block is searched for
the identifier at once. Documents that cross blocks are put together by a prefix scan over the
blocks of a file, of which only two numbers a block are needed: its tokens and the place of its
last separator.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidemark.llm.common import document_batches, new_table, stored

#: Tokens of a block; bytes of a token.
BLOCK, WIDTH = 1 << 16, 2
#: Blocks that are scanned together; longer files are scanned in two levels.
SPAN = 4096


@lru_cache(2)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoder of a file of ranked tokens, made once in a process."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def write_flat(
    docs: DataFrame, ranks: str, pattern: str, end: int, block: int = BLOCK, width: int = WIDTH, path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Write ``docs`` (doc_id, text) as flat token files, one for each partition.

    Each task encodes its documents and writes them itself, so the tokens are on disk once and
    are not shuffled: ``path``/part=tokens has the files, in which nothing but tokens is.
    Returns their blocks of at most ``block`` tokens (file, block, payload), and which document is
    the how-manieth of a file (file, ordinal, doc_id); a file goes by the number of its task.
    Null and empty texts are documents without tokens, repeated rows documents of their own; an
    empty table gives no tokens; other columns are ignored.
    """
    path = path or new_table(docs.sparkSession)
    kind, sign = np.dtype(f"<u{width}"), end.to_bytes(width, "little")
    names = ["part", "seq", "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(ranks, pattern)
        held, size, written, seen = [], 0, 0, 0

        def row(part: str, seq: list[int], body: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * len(seq), pa.string()), pa.array(seq, pa.int64()), pa.array(body, pa.binary())], names
            )

        def tokens() -> pa.RecordBatch:
            whole = np.concatenate(held)[:-1].tobytes()  # the writer ends each row with the identifier
            return row("tokens", [written], [whole])

        for batch in batches:
            ids = ["" if i is None else str(i) for i in batch.column(0).to_pylist()]
            yield row("order", list(range(seen, seen + len(ids))), [f"{seen + j},{i}".encode() for j, i in enumerate(ids)])
            seen += len(ids)
            for text in batch.column(1):
                found = encoder.encode_ordinary(text.as_py() or "")
                held.append(np.append(np.array(found, kind), kind.type(end)))
                size += len(held[-1])
                if size >= block:
                    yield tokens()
                    written, held, size = written + 1, [], 0
        if size:
            yield tokens()

    rows = document_batches(docs.select(F.col("doc_id").cast("long"), "text")).mapInArrow(run, "part string, seq long, body binary")
    (
        rows.sortWithinPartitions("part", "seq")
        .select("part", F.col("body").cast("string").alias("body"))
        .write.partitionBy("part")
        .option("encoding", "ISO-8859-1")
        .option("lineSep", sign.decode("latin-1"))
        .text(path)
    )
    spark = docs.sparkSession
    files = read_flat(spark, path, block, width, cut=max(sign), part="tokens")
    return files.withColumn("file", _number(F.col("file"))), _order(spark, path, sign.decode("latin-1"))


def _number(name: Column) -> Column:
    """The number of the task that wrote a file, from the file's name or path."""
    return F.regexp_extract(name, r"part-(\d+)-[^/]*$", 1).cast("int")


def _order(spark: SparkSession, path: str, sign: str) -> DataFrame:
    """(file, ordinal, doc_id) as ``write_flat`` left it beside the tokens."""
    lines = spark.read.option("encoding", "ISO-8859-1").option("lineSep", sign).text(path)
    cells = F.split("value", ",")
    return _part(lines, "order").select(
        _number(F.col("_metadata.file_name")).alias("file"),
        cells[0].cast("long").alias("ordinal"),
        F.when(cells[1] != "", cells[1].cast("long")).alias("doc_id"),
    )


def _part(lines: DataFrame, part: str) -> DataFrame:
    """The lines of the files of one part; a table without rows has no parts."""
    return lines.where(F.col("part") == part) if "part" in lines.columns else lines.limit(0)


def _lines(spark: SparkSession, path: str, cut: int, part: str | None) -> DataFrame:
    """(file, split, size, line) of the files below ``path``, in order within a split."""
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:  # splits must be the same whenever the files are read
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
    reader = spark.read.option("encoding", "ISO-8859-1").option("lineSep", chr(cut))
    text = reader.text(path) if part is None else _part(reader.text(path), part)
    return document_batches(text).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("_metadata.file_size").alias("size"),
        F.col("value").cast("binary").alias("line"),
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The rows of one split after another."""
    file = batch.column("file").dictionary_encode().indices.to_numpy()
    split = batch.column("split").to_numpy()
    new = np.flatnonzero((np.diff(file, prepend=-1) != 0) | (np.diff(split, prepend=-1) != 0))
    for a, b in zip(new, [*new[1:], len(split)]):
        yield (batch.column("file")[a].as_py(), int(split[a])), batch.slice(a, b - a)


#: Bytes at the start of a file that Hadoop's line reader leaves out.
_MARK = b"\xef\xbb\xbf"


#: Splits of which a table of about 200 bytes each is sent to every executor; beyond that the
#: lines are dealt out by split.
BROADCAST_SPLITS = 1_000_000


def read_flat(
    spark: SparkSession, path: str, block: int = BLOCK, width: int = WIDTH, cut: int = 10, part: str | None = None
) -> DataFrame:
    """Blocks (file, block, payload) of the flat token files below ``path``, in any store that
    Spark reads; a file is named by its path and may have any size.

    A file is read in splits, as lines that end at the byte ``cut`` (not at a meaning of it), of
    which each must fit a row; a byte of the end identifier that is rare elsewhere is a good
    one. A first reading counts the bytes of each split. So the second knows where in the file
    a split begins, and leaves the rest of a token that began in the split before to that one.
    Blocks are whole tokens, at most ``block`` of them, numbered in order within a file. With
    ``part``, only files in folders ``part=...`` of that name are read, and there may be none.
    """
    sign, step, edge = bytes([cut]), block * width, width - 1

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list] = {}
        for batch in batches:
            for key, part in _runs(batch):
                lines = part.column("line")
                row = found.setdefault(key, [part.column("size")[0].as_py(), 0, b""])
                row[1] += sum(map(len, lines.to_pylist())) + len(lines)
                if len(row[2]) < edge:
                    row[2] = (row[2] + b"".join(x + sign for x in lines.slice(0, edge).to_pylist()))[:edge]
        columns = [*zip(*[(*key, *row) for key, row in found.items()])] or [()] * 5
        kinds = pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "split", "size", "n", "head"])

    splits = _lines(spark, path, cut, part).mapInArrow(measured, "file string, split long, size long, n long, head binary")
    in_file = W.partitionBy("file").orderBy("split")  # one row for each split
    before = F.coalesce(F.sum("n").over(in_file.rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long"))
    # all lines end with the sign, the last one of a file perhaps only here
    off = F.col("size") - F.sum("n").over(W.partitionBy("file"))
    mark = F.when(off.isin(0, -1), 0).when(off.isin(len(_MARK), len(_MARK) - 1), len(_MARK)).otherwise(
        F.raise_error(F.concat(F.lit("bytes of a flat file are missing: "), F.col("file"))).cast("int")
    )
    nothing = F.lit(b"")
    behind = F.concat(nothing, *[F.coalesce(F.lead("head", i).over(in_file), nothing) for i in range(1, width)])
    splits = splits.select(
        "file", "split", before.alias("before"), mark.alias("mark"), behind.alias("behind"), (F.row_number().over(in_file) - 1).alias("nth")
    )
    splits, lines, key = stored(splits), _lines(spark, path, cut, part), ["file", "split"]
    if splits.count() <= BROADCAST_SPLITS:
        joined = lines.join(F.broadcast(splits), key, "left")
    else:
        numbered = lines.withColumn("_at", F.monotonically_increasing_id())
        joined = numbered.join(splits, key, "left").repartition(*key).sortWithinPartitions(*key, "_at").drop("_at")

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, file, held, at, skip, size, nth, behind = None, "", bytearray(), 0, 0, 0, 0, b""

        def blocks(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal at, skip
            del held[max(0, size - at) :]
            if skip and (last or len(held) > skip):
                gone = min(skip, len(held))
                del held[:gone]
                at, skip = at + gone, skip - gone
            if last and held:
                held.extend(behind[: min(-(at + len(held)) % width, size - at - len(held))])
            rows = []
            while held and not skip:
                upto = (at // step + 1) * step - at
                if len(held) < upto and not last:
                    break
                rows.append((file, at // step + nth, bytes(held[:upto])))
                at += len(rows[-1][2])
                del held[:upto]
            if rows:
                names, numbers, payloads = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array(numbers, pa.int64()), pa.array(payloads, pa.binary())],
                    ["file", "block", "payload"],
                )

        for batch in batches:
            for key, part in _runs(batch):
                if key != now:
                    yield from blocks(True)
                    now, file = key, key[0]
                    size, start, mark, nth, behind = (part.column(c)[0].as_py() for c in ("size", "before", "mark", "nth", "behind"))
                    if start is None:
                        raise RuntimeError(f"the splits of {file} have changed")
                    at = start + mark if nth else 0
                    held[:] = b"" if nth else _MARK[:mark]
                    skip = -at % width
                held += b"".join(x + sign for x in part.column("line").to_pylist())
                yield from blocks(False)
        yield from blocks(True)

    return joined.mapInArrow(cut_up, "file string, block long, payload binary")


def scan(files: DataFrame, end: int, width: int = WIDTH) -> DataFrame:
    """The documents of flat token ``files`` (file, block, payload), in order.

    Columns: file, ordinal (from 0), first_token (place in the file), n_tokens without the
    separator, terminated (false for tokens after the last separator of a file). Two separators
    in a row are a document of no tokens. Empty or null payloads and empty tables give nothing;
    other columns are ignored.
    """
    kind = np.dtype(f"<u{width}")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, sizes = [], []
            for payload in batch.column("payload"):
                tokens = np.frombuffer(payload.as_py(), kind)
                ends.append(np.flatnonzero(tokens == end))
                sizes.append(len(tokens))
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), pa.array(sizes, pa.int64()), pa.array(ends, pa.list_(pa.int64()))],
                ["file", "block", "n", "ends"],
            )

    kinds = dict(files.dtypes)
    blocks = stored(
        files.where("length(payload) > 0").select("file", "block", "payload")
        .mapInArrow(found, f"file {kinds['file']}, block {kinds['block']}, n long, ends array<long>")
    )
    prefixed = _prefixed(blocks.select("file", "block", "n", F.size("ends").alias("m"), F.array_max("ends").alias("last")))
    inside = blocks.where(F.size("ends") > 0).join(prefixed, ["file", "block"])
    starts = F.concat(
        F.array(F.col("open")),
        F.transform(F.slice("ends", 1, F.size("ends") - 1), lambda e: F.col("offset") + e + 1),
    )
    closed = inside.select(
        "file", "seen", "offset", F.posexplode(F.arrays_zip(F.col("ends").alias("e"), starts.alias("s"))).alias("i", "d")
    ).select(
        "file",
        (F.col("seen") + F.col("i")).alias("ordinal"),
        F.col("d.s").alias("first_token"),
        (F.col("offset") + F.col("d.e") - F.col("d.s")).alias("n_tokens"),
        F.lit(True).alias("terminated"),
    )
    rest = (
        prefixed.groupBy("file")
        .agg(F.max("stop").alias("stop"), F.max("next_open").alias("open"), F.max("next_seen").alias("ordinal"))
        .where("stop > open")
        .select("file", "ordinal", F.col("open").alias("first_token"), (F.col("stop") - F.col("open")).alias("n_tokens"), F.lit(False).alias("terminated"))
    )
    return closed.unionByName(rest)


def _prefixed(blocks: DataFrame) -> DataFrame:
    """For each block (file, block, n tokens, m separators, last one's place) what stands before
    it in its file: ``offset`` tokens, ``seen`` separators, ``open``, where the document begins
    that is open at its start; and the same after it (stop, next_seen, next_open).

    Sums and maxima are taken within spans of blocks, then over the spans of a file.
    """
    spanned = blocks.withColumn("span", F.floor(F.col("block") / SPAN))
    inner = W.partitionBy("file", "span").orderBy("block").rowsBetween(W.unboundedPreceding, 0)
    local = spanned.select("*", F.sum("n").over(inner).alias("n_upto"), F.sum("m").over(inner).alias("m_upto"))
    local = local.withColumn("open_upto", F.max(F.col("n_upto") - F.col("n") + F.col("last") + 1).over(inner))
    spans = local.groupBy("file", "span").agg(F.sum("n").alias("sn"), F.sum("m").alias("sm"), F.max("open_upto").alias("so"))
    outer = W.partitionBy("file").orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    spans = spans.select(
        "*", F.coalesce(F.sum("sn").over(outer), zero).alias("n0"), F.coalesce(F.sum("sm").over(outer), zero).alias("m0")
    )
    upto = W.partitionBy("file").orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    spans = spans.withColumn("o0", F.coalesce(F.max(F.col("n0") + F.col("so")).over(upto), zero)).select("file", "span", "n0", "m0", "o0")
    both = local.join(spans, ["file", "span"])
    before = W.partitionBy("file", "span").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    opened = F.max(F.col("n0") + F.col("open_upto")).over(before)
    return both.select(
        "file",
        "block",
        (F.col("n0") + F.col("n_upto") - F.col("n")).alias("offset"),
        (F.col("m0") + F.col("m_upto") - F.col("m")).alias("seen"),
        F.greatest(F.coalesce(opened, zero), "o0").alias("open"),
        (F.col("n0") + F.col("n_upto")).alias("stop"),
        (F.col("m0") + F.col("m_upto")).alias("next_seen"),
        F.greatest(F.coalesce(F.col("n0") + F.col("open_upto"), zero), "o0").alias("next_open"),
    )
