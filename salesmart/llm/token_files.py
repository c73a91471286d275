"""Token ids of all documents as wavelet-matrix files, in ascending order of their ids.

Documents are dealt to tasks by ranges of their id (one shuffle of the texts), sorted and
encoded there once; a task closes a file after the document that fills it, so memory stays
bounded by a file and one text.  The rows that describe the files (the manifest) go through
Spark's own commit, and readers open only files that it names, so files of failed or
repeated attempts are left over but never read.  The places of the files' first ids follow
from one total for each task.

Files are written and read by the tasks through ``pyarrow.fs`` in the folder given, which
the driver qualifies with Hadoop's file system; it must be one that all executors reach.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.arrow_text import Recent, slices
from salesmart.llm.common import small_batches, stored, text_of
from salesmart.llm.wavelet import WaveletMatrix, image

#: ids in a file, about; characters of text to a task, about
SHARD_TOKENS = 4_000_000
TASK_CHARS = 32_000_000
#: words whose ids a worker remembers, twice; words encoded at a time
CACHED_WORDS = 250_000
ENCODED_WORDS = 4_000

# Pattern, normalizers and word end of the tokenizers whose words of plain
# letters can be cut here into the pieces that the tokenizer cuts them into.
CUT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
WORD_END = "</w>"

#: texts of ASCII and composed Latin-1 letters (no control characters but line ends and
#: tabs), which lower-casing changes letter by letter
SIMPLE = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ]*")
#: stands behind every text; SIMPLE ones do not hold it
END = "\0"
#: what a byte of a lowered SIMPLE text belongs to: a blank, a letter (all beyond ASCII
#: do), a digit, the end, anything else
BLANK, LETTER, DIGIT, LAST, OTHER = range(5)
KIND = np.full(256, OTHER, dtype=np.uint8)
KIND[[9, 10, 13, 32]] = BLANK
KIND[[*range(97, 123), *range(128, 256)]] = LETTER
KIND[48:58] = DIGIT
KIND[0] = LAST


@lru_cache(maxsize=4)
def _tokenizer(blob: bytes):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_buffer(blob)


@lru_cache(maxsize=4)
def _piecewise(blob: bytes):
    """The tokenizer without its normalizers and which of its ids end a piece, or None for
    one that cuts words by other rules than SIMPLE and cut_pieces stand for."""
    from tokenizers import Tokenizer
    made = json.loads(blob)
    cutter = ((made.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    normalizers = [n["type"] for n in (made.get("normalizer") or {}).get("normalizers") or []]
    if (cutter.get("pattern") != {"Regex": CUT_PATTERN} or normalizers != NORMALIZERS
            or made["model"].get("end_of_word_suffix") != WORD_END):
        return None
    tokenizer = Tokenizer.from_buffer(blob)
    tokenizer.normalizer = None
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
    ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
    return tokenizer, ends


def cut_pieces(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The pieces by CUT_PATTERN of simple texts, lowered, END behind each text and runs of
    blanks between the pieces, and the places of the ENDs among them."""
    raw = END.join([*texts, ""]).lower().encode()
    points = np.frombuffer(raw, dtype=np.uint8)
    kind = KIND[points]
    first = np.ones(len(points), dtype=bool)
    first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT) | (kind[1:] == LAST)
    # 's, 're and their like where the apostrophe begins a piece
    at = np.flatnonzero(first & (points == ord("'")))
    one, two = points[at + 1], points[np.minimum(at + 2, len(points) - 1)]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = (np.isin(one, [ord(c) for c in "rv"]) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    first[at[short | long] + 1] = False
    first[at[short] + 2] = True
    first[at[long] + 3] = True
    starts = np.flatnonzero(first)
    pieces = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(np.append(starts, len(points)).astype(np.int64)), pa.py_buffer(raw))
    return pieces.dictionary_encode(), np.flatnonzero(kind[starts] == LAST)


@lru_cache(maxsize=2)
def word_encoder(blob: bytes) -> Callable[[pa.Array], list[bytes]]:
    """A function of texts to their ids as little-endian 32-bit integers, made once in a
    process: what it learned of words serves later tasks, too.

    For tokenizers whose pieces never cross a blank and that drop it: a text's ids are
    those of its words cut at blanks, one after the other, so every distinct word is
    encoded once.  Strings of special tokens become these, as in the library.  Where the
    tokenizer's rules are known, simple texts, and simple words of other texts, are cut into
    its pieces, of which fewer differ than words do, and new pieces are encoded as one text,
    blanks between them."""
    tokenizer, piecewise = _tokenizer(blob), _piecewise(blob)
    known, of_piece = Recent(CACHED_WORDS), Recent(CACHED_WORDS)

    def learn_pieces(pieces: list[str]) -> None:
        bare, ends = piecewise
        for at in range(0, len(pieces), ENCODED_WORDS):
            part = pieces[at:at + ENCODED_WORDS]
            ids = np.array(bare.encode(" ".join(part), add_special_tokens=False).ids, dtype="<u4")
            raw, a = ids.tobytes(), 0
            for piece, b in zip(part, (4 * np.flatnonzero(ends[ids]) + 4).tolist(), strict=True):
                of_piece.new[piece] = raw[a:b]
                a = b

    def simple(text: str) -> bool:
        return piecewise is not None and SIMPLE.fullmatch(text) is not None and "<|" not in text

    def joined(found: pa.Array, last: np.ndarray) -> list[bytes]:
        """The values up to each of the last places, as one."""
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(found).to_numpy())])
        ends = ends[np.concatenate([[0], last])].tolist()
        raw = found.buffers()[2].to_pybytes() if ends[-1] else b""
        return [raw[a:b] for a, b in zip(ends[:-1], ends[1:])]

    def by_pieces(texts: list[str]) -> list[bytes]:
        """Ids of simple texts."""
        coded, ends = cut_pieces(texts)
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        learn_pieces(of_piece.missing([p for p in pieces if p[0] not in "\t\n\r " + END]))
        of = pa.array([of_piece.new.get(p, b"") for p in pieces], pa.large_binary())
        return joined(of.take(coded.indices), ends + 1)

    def learn(words: list[str]) -> None:
        plain = [w for w in words if simple(w)]
        if plain:
            known.new.update(zip(plain, by_pieces(plain), strict=True))
            words = [w for w in words if w not in known.new]
        for at in range(0, len(words), ENCODED_WORDS):
            part = words[at:at + ENCODED_WORDS]
            for word, found in zip(part, tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                known.new[word] = np.array(found.ids, dtype="<u4").tobytes()

    def by_words(texts: pa.Array) -> list[bytes]:
        parts = pc.split_pattern(texts, " ")
        coded = parts.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        learn(known.missing(words))
        of_word = pa.array(map(known.new.__getitem__, words), pa.large_binary())
        return joined(of_word.take(coded.indices), np.cumsum(pc.list_value_length(parts).to_numpy()))

    def encode(texts: pa.Array) -> list[bytes]:
        plain = texts.to_numpy(zero_copy_only=False).tolist()
        whole = [simple(t) for t in plain]
        cut = iter(by_pieces([t for t, w in zip(plain, whole) if w]) if any(whole) else [])
        rest = iter(by_words(texts.filter(pa.array([not w for w in whole]))) if not all(whole) else [])
        return [next(cut if w else rest) for w in whole]
    return encode


def _folder(spark: SparkSession, path: str) -> str:
    """The path with its file system's scheme, as Hadoop resolves it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(at).toString()


def _opened(uri: str) -> tuple[pafs.FileSystem, str]:
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri("s3" + uri[len(scheme):] if scheme in ("s3a", "s3n") else uri)


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes the ids of all texts, each with ``end_id`` behind them, into files below
    ``folder`` and returns their manifest, stored: file, start (ids of all files before),
    n_docs, n_tokens, bytes.

    Documents stand in ascending order of ``id_col``, null ids last, rows of equal ids by a
    digest of their texts.  A null or empty text has the end alone.  Other columns are
    ignored.  An empty table writes no file.
    """
    spark = docs.sparkSession
    text = text_of(text_col)
    chars = docs.agg(F.sum(F.length(text)).alias("n")).first()["n"] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // TASK_CHARS))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("digest"), text.alias("text"))
    order = [F.col("id").asc_nulls_last(), F.col("digest")]
    # equal rows, were they a third of all, are dealt over tasks by where they were read
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    rows = (rows.repartitionByRange(tasks, *order, F.col("place")).sortWithinPartitions(*order, "place")
            .select("id", "text"))
    small_batches(spark)
    with open(tokenizer_path, "rb") as f:
        blob = spark.sparkContext.broadcast(f.read())        # a vocabulary
    root = _folder(spark, folder)
    end = np.array([end_id], dtype="<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        encode = word_encoder(blob.value)
        fs, base = _opened(root)
        fs.create_dir(base, recursive=True)
        ids, texts, held, before, number = [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            nonlocal ids, texts, held, before, number
            tokens = np.frombuffer(b"".join(texts), dtype="<u4")
            sizes = pa.array([len(t) // 4 for t in texts], pa.int64())
            data = image(tokens, pa.RecordBatch.from_arrays([pa.array(ids, id_type), sizes], names=["id", "n_tokens"]))
            name = f"{task:06d}-{number:05d}-{uuid.uuid4().hex}.wvt"
            with fs.open_output_stream(f"{base}/{name}") as out:
                out.write(data)
            row = pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in ((f"{root}/{name}", pa.string()), (task, pa.int32()), (before, pa.int64()),
                                               (len(ids), pa.int64()), (len(tokens), pa.int64()), (len(data), pa.int64()))],
                names=["file", "task", "before", "n_docs", "n_tokens", "bytes"])
            before, number, ids, texts, held = before + len(tokens), number + 1, [], [], 0
            return row

        for batch in batches:
            id_type = batch.column("id").type
            for part in slices(batch, "text"):
                for key, found in zip(part.column("id").to_pylist(), encode(part.column("text"))):
                    ids.append(key)
                    texts.append(found + end)
                    held += len(found) // 4 + 1
                    if held >= shard_tokens:
                        yield close()
        if ids:
            yield close()

    manifest = stored(rows.mapInArrow(write, "file string, task int, before long, n_docs long, n_tokens long, bytes long"),
                      "token_manifest")
    totals = manifest.groupBy("task").agg(F.sum("n_tokens").alias("n")).collect()       # one row for each task
    first, at = [], 0
    for r in sorted(totals):
        first.append((r["task"], at))
        at += r["n"]
    firsts = spark.createDataFrame(first, "task int, first long")
    return manifest.join(F.broadcast(firsts), "task").select(
        "file", (F.col("first") + F.col("before")).alias("start"), "n_docs", "n_tokens", "bytes")


def _files(manifest: DataFrame) -> DataFrame:
    """The manifest dealt out so that a task opens a few files."""
    spark = manifest.sparkSession
    total = manifest.agg(F.sum("bytes").alias("n")).first()["n"] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (8 * SHARD_TOKENS)))
    return manifest.repartition(tasks, "file")


def _matrix(uri: str) -> WaveletMatrix:
    fs, path = _opened(uri)
    with fs.open_input_file(path) as f:
        return WaveletMatrix(f.read()).checked()


def read_token_files(manifest: DataFrame, id_type: T.DataType, id_col: str = "doc_id", ids: bool = True) -> DataFrame:
    """Per document of the files: ``id_col``, start (ids of all documents before it),
    n_tokens, ids_crc32 (of its ids as little-endian 32-bit integers) and, if ``ids``, the
    ids themselves.  An empty manifest gives no rows."""
    schema = T.StructType([T.StructField(id_col, id_type), *T.StructType.fromDDL(
        "start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else "")).fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                matrix = _matrix(uri)
                docs, tokens = matrix.docs().combine_chunks(), matrix.tokens().astype("<u4")
                sizes = docs.column("n_tokens").to_numpy()
                cut = np.concatenate([[0], np.cumsum(sizes)])
                raw = memoryview(tokens).cast("B")
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
                columns = [docs.column("id").combine_chunks(), pa.array(start + cut[:-1], pa.int64()),
                           pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())]
                if ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(tokens.astype(np.int32))))
                whole = pa.RecordBatch.from_arrays(columns, names=schema.names)
                for at in range(0, whole.num_rows, 1000):
                    yield whole.slice(at, 1000)
    return _files(manifest).select("file", "start").mapInArrow(read, schema)


def token_occurrences(manifest: DataFrame, tokens: list[int], places: bool = False) -> DataFrame:
    """How often each of ``tokens`` occurs in every file (file, token, n), by rank on the
    bit planes without decoding; with ``places`` also where, as ascending places among the
    ids of all documents (start and ids as in ``read_token_files``)."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                matrix = _matrix(uri)
                columns = [pa.array([uri] * len(tokens)), pa.array(tokens, pa.int32()),
                           pa.array([matrix.count(t) for t in tokens], pa.int64())]
                if places:
                    columns.append(pa.array([[start + i for i in matrix.occurrences(t)] for t in tokens], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=["file", "token", "n", "places"][:len(columns)])
    return _files(manifest).select("file", "start").mapInArrow(
        look, "file string, token int, n long" + (", places array<long>" if places else ""))
