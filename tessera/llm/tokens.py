"""Token-ID files: Parquet list columns, dictionary encoded, with controlled row groups, pages and page indexes.

File format: rows in ascending (doc_id, text hash) order over files; columns doc_id, file (int, its place in that
order), n_tokens and ids (list of int32). Ids are dictionary encoded; doc_id and counts fall to delta encoding
(format version 2). Small pages with column and offset indexes let a reader fetch few documents, and a reader of
doc_id and n_tokens never touches the ids.

Defined results: a null text is encoded as an empty one, so holds the end id only; repeated doc_ids keep all rows, in
order of their text's hash; a null doc_id comes first; an empty table gives an empty result. Other columns are ignored.
Strings of special tokens inside a text are treated as the tokenizer treats them.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import give_back, read, shared_path, small_batches, stash

#: Words of a generation, of which a worker remembers two until its task ends.
CACHE_WORDS, CACHE_TAILS = 150_000, 10_000
TOKENIZER = "word_bpe_49k.json"
SHARD_BYTES, SLICE_DOCS, BATCH_DOCS = 32 << 20, 768, 1536
ROW_GROUP_BYTES, PAGE_BYTES = 16 << 20, 256 << 10
#: Of each line: letters that normalization leaves as they are and that are pre-tokenized whole, and marks after them, also whole.
_PLAIN = re.compile("[a-zà-öø-ÿ]+")
_PARTS = re.compile(r"^(?:([a-zà-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)|.*)$", re.MULTILINE)
#: A mark after a word and before a blank, which is a token run of its own.
_MARK = r"([a-z0-9])([,.]) "


class WordEncoder:
    """Encodes texts word by word with a tokenizer that drops white space and merges nothing across it.

    Words between ASCII white space are encoded once and remembered. A word of letters and marks after them is put
    together from the two. Plain lower-case words skip the tokenizer's normalizer and are encoded many at a time:
    a token that ends a word shows where the next begins. All else goes through the whole tokenizer, each by itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole, self.fast = Tokenizer.from_file(path), Tokenizer.from_file(path)
        vocab = self.whole.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.plain = "the</w>" in vocab and self.whole.encode("The", add_special_tokens=False).ids == [vocab["the</w>"]]
        self.fast.normalizer = None
        self.fast.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ids: dict[str, bytes] = {}
        self.last: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}

    def forget(self) -> None:
        self.ids, self.last, self.tails = {}, {}, {"": b""}

    def _whole(self, texts: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(texts), 10_000):
            out += [np.array(e.ids, "<i4").tobytes() for e in self.whole.encode_batch_fast(texts[at : at + 10_000], add_special_tokens=False)]
        return out

    def _fast(self, words: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(words), 10_000):
            part = words[at : at + 10_000]
            lines = [" ".join(part[i : i + 500]) for i in range(0, len(part), 500)]
            ids = np.concatenate([np.array(e.ids, "<i4") for e in self.fast.encode_batch_fast(lines, add_special_tokens=False)])
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(ends) != len(part) or ends[-1] != 4 * len(ids):
                out += self._whole(part)
                continue
            flat = ids.tobytes()
            out += [flat[i:j] for i, j in zip([0, *ends[:-1]], ends)]
        return out

    def learn(self, words: list[str]) -> None:
        if not self.plain:
            self.ids.update(zip(words, self._whole(words)))
            return
        whole = _PLAIN.fullmatch
        plain = [w for w in words if (w.isalpha() and w.islower() if w.isascii() else whole(w))]
        self.ids.update(zip(plain, self._fast(plain)))
        rest = [w for w in words if w not in self.ids]
        parts = _PARTS.findall("\n".join(rest).lower()) if rest else []
        cores = {c: self._known(c) for c, _ in parts if c}
        new = [c for c, x in cores.items() if x is None]
        cores.update(zip(new, self._fast(new)))
        tails = list({t for _, t in parts if t not in self.tails})
        if len(self.tails) > CACHE_TAILS:
            self.tails, tails = {"": b""}, list({t for _, t in parts if t})
        self.tails.update(zip(tails, self._whole(tails)))
        tails = self.tails
        self.ids.update([(w, cores[c] + tails[t]) for w, (c, t) in zip(rest, parts) if c])
        odd = [w for w, (c, _) in zip(rest, parts) if not c]
        self.ids.update(zip(odd, self._whole(odd)))

    def _known(self, word: str) -> bytes | None:
        """Ids of a word met in this generation or the last, which passes on what is still in use."""
        x = self.ids.get(word)
        if x is None and (x := self.last.get(word)) is not None:
            self.ids[word] = x
        return x

    def encode(self, texts: pa.StringArray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each ended by end_id, and their counts. The different words of a slice are looked up once."""
        # lower case first, but not where that could make the string of a special token
        if self.plain and not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), _MARK, r"\1 \2 ")
        split = pc.ascii_split_whitespace(texts)
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        words = split.flatten().dictionary_encode()
        names = words.dictionary
        names = pc.binary_join(pa.ListArray.from_arrays([0, len(names)], names), "\n")[0].as_py().split("\n") if len(names) else []
        if len(self.ids) > CACHE_WORDS:
            self.ids, self.last = {}, self.ids
        found = [*map(self.ids.get, names)]
        known = self._known
        new = [w for w, x in zip(names, found) if x is None and known(w) is None]
        if None in found:
            if new:
                self.learn(new)
            ids = self.ids
            found = [x if x is not None else ids[w] for w, x in zip(names, found)]
        flat = np.frombuffer(b"".join(found), "<i4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        start = np.cumsum(size) - size
        at = words.indices.to_numpy()
        each = size[at]
        upto = np.concatenate([[0], np.cumsum(each)])
        place = np.repeat((start[at] - upto[:-1]).astype(np.int32), each)
        place += np.arange(len(place), dtype=np.int32)
        ids = flat[place]
        counts = np.diff(upto[offsets])
        return np.insert(ids, upto[offsets[1:]], end_id), counts + 1


@lru_cache(1)
def word_encoder(path: str | None) -> WordEncoder:
    """The encoder of a tokenizer file; without a path that of TOKENIZER, which is looked for on the machine that encodes."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    return WordEncoder(path)


def encode(documents: DataFrame, tokenizer: str | None, end_id: int) -> DataFrame:
    """(doc_id, text) -> doc_id, n_tokens, ids."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_encoder(tokenizer)
        for b in batches:
            for at in range(0, len(b), SLICE_DOCS):
                part = b.slice(at, SLICE_DOCS)
                flat, counts = words.encode(part["text"], end_id)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], schema=schema)
            give_back()
        words.forget()
        give_back()

    return documents.mapInArrow(run, "doc_id long, n_tokens long, ids array<int>")


def write_tokens(documents: DataFrame, path: str, tokenizer: str | None, end_id: int, shard_bytes: int = SHARD_BYTES) -> None:
    """Deal out by ranges of (doc_id, text hash), so that no file outgrows shard_bytes of text by much, sort, encode and write."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), text.alias("text"))
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(max(1, -(-size // shard_bytes), min(d.sparkSession.sparkContext.defaultParallelism, size >> 20)))
    d = d.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    out = encode(d, tokenizer, end_id).select("doc_id", F.spark_partition_id().alias("file"), "n_tokens", "ids")
    with small_batches(d.sparkSession, BATCH_DOCS):
        (
            out.write.option("compression", "snappy").option("parquet.writer.version", "v2")
            .option("parquet.enable.dictionary", "true").option("parquet.block.size", ROW_GROUP_BYTES)
            .option("parquet.page.size", PAGE_BYTES).option("parquet.dictionary.page.size", 1 << 20).parquet(path)
        )


def digest(spark, path: str) -> DataFrame:
    """Read token files back: doc_id, start, n_tokens, ids_crc32.

    Starts come from the counts alone: a total per file, then running sums within a file.
    """
    files = spark.read.parquet(path)

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b["ids"]
            flat, at = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<u4"), ids.offsets.to_numpy()
            sums = [zlib.crc32(flat[i:j]) for i, j in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["file"], b["row"], b["n_tokens"], pa.array(sums, pa.int64())], ["doc_id", "file", "row", "n_tokens", "ids_crc32"])

    # place of a row in its file: files are written and read in order
    rows = files.select("doc_id", "file", F.col("_metadata.row_index").alias("row"), "n_tokens", "ids")
    rows = rows.mapInArrow(crc, "doc_id long, file int, row long, n_tokens long, ids_crc32 long")
    totals = files.groupBy("file").agg(F.sum("n_tokens").alias("t"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("file", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("base"))
    w = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum("n_tokens").over(w), F.lit(0)))
    return rows.join(totals, "file").select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def token_files(documents: DataFrame, tokenizer: str | None = None, end_id: int = 2, path: str | None = None) -> tuple[DataFrame, str]:
    """Write all documents and read their digest back; gives it and the files' path."""
    spark = documents.sparkSession
    path = path or shared_path(spark, "tokens")
    write_tokens(documents, path, tokenizer, end_id)
    with small_batches(spark, BATCH_DOCS):
        return stash(digest(spark, path), "token_digest"), path


def op7_token_files(spark, sf_dir: str) -> DataFrame:
    return token_files(read(spark, sf_dir, "documents"))[0]
