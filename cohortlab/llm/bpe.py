"""Byte-level BPE encoding and decoding (operator 1).

1. Each task cuts its documents into pre-tokens and writes blocks: positions of
   every pre-token, and the block's distinct pre-tokens (``blocks.py``).
2. The distinct pre-tokens of all blocks are shuffled by pre-token and sorted;
   equal ones are neighbours, so each is encoded once, with constant memory.
3. The ids go back to the blocks, which are bucketed by block id and do not
   move, and each document's ids are put together by position.
4. Decoding joins every id with the token-byte table. The table has one row per
   rank of the vocabulary file (bounded by the file, checked), so it is sent to
   the tasks and joined by position.

Cutting in two steps: a run of white space up to its last character, and a
non-space run with one space before it, never share a token under the pattern.
Such units are found by a byte scan, and the full pattern runs once per distinct
unit of a block. Texts with other white space than ASCII's are cut by the full
pattern as a whole.

Defined cases: a null or empty text has no tokens; ids of any repeated row are
given for each row; a null id is kept; an empty table gives an empty result;
texts are whole, whatever their length; extra columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm.blocks import BLOCK_BYTES, coded_blocks, pack, unpack
from cohortlab.llm.common import table, without

MAX_VOCABULARY = 1 << 20
# Unicode's White_Space, as the pattern's \s means it.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_UNIT = re.compile(rb" ?[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+(?![^\x20\x09-\x0D])|[\x20\x09-\x0D]+")
_OTHER_WHITE = re.compile(r"[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def explicit_white(pattern: str) -> str:
    """The pattern with \\s and \\S spelt out, inside and outside of classes."""
    return (pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]"))


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Token bytes -> id from a rank file (base64 token, space, rank per line)."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    if len(ranks) > MAX_VOCABULARY:
        raise ValueError(f"{path}: more than {MAX_VOCABULARY} tokens")
    return ranks


def cutter(pattern: str) -> tuple[Callable[[bytes], list[bytes]], Callable[[bytes], list[bytes]]]:
    """(units of a text, pre-tokens of a unit) for a pattern of the byte-level kind."""
    full = regex.compile(explicit_white(pattern))

    def units(blob: bytes) -> list[bytes]:
        if not blob.isascii() and _OTHER_WHITE.search(text := blob.decode()):
            return [x.encode() for x in full.findall(text)]
        return _UNIT.findall(blob)

    def tokens(unit: bytes) -> list[bytes]:
        text = unit.decode()
        body = text[1:] if text[:1] == " " else text
        if body.isalpha():
            return [unit]
        if body[-1:] in ".,;:" and body[:-1].isalpha():
            return [unit[:-1], unit[-1:]]
        return [x.encode() for x in full.findall(text)]

    return units, tokens


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank merges first, leftmost on ties."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > 48:
        return _merge_long(piece, ranks)
    none = MAX_VOCABULARY + 1
    parts = [piece[i:i + 1] for i in range(len(piece))]
    get = ranks.get
    pair = [get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
    while pair:
        low = min(pair)
        if low == none:
            break
        i = pair.index(low)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pair[i]
        if i < len(pair):
            pair[i] = get(parts[i] + parts[i + 1], none)
        if i:
            pair[i - 1] = get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap and linked neighbours: n log n for long runs."""
    n = len(piece)
    end = list(range(1, n + 1))  # part i covers piece[i:end[i]]
    left, alive = list(range(-1, n - 1)), [True] * n
    heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = end[i] if alive[i] else n
        if not alive[i] or j >= n or end[j] - i != size:
            continue  # one of the two has merged since
        end[i] = end[j]
        alive[j] = False
        if end[i] < n:
            left[end[i]] = i
            if (r := ranks.get(piece[i:end[end[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[end[i]] - i))
        if (k := left[i]) >= 0 and (r := ranks.get(piece[k:end[i]])) is not None:
            heapq.heappush(heap, (r, k, end[i] - k))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


def _encode_sorted(shared, flush_rows: int = 1 << 20):
    """Rows (word, block, idx) sorted by word -> per block: steps of idx, lengths and ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        last, last_ids = None, []
        blocks: list[np.ndarray] = []
        idx: list[np.ndarray] = []
        lens: list[np.ndarray] = []
        flat: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            block, index, length = np.concatenate(blocks), np.concatenate(idx), np.concatenate(lens)
            start, ids = np.concatenate([[0], np.cumsum(length)]), np.concatenate(flat)
            rows: list[tuple] = []
            order = np.lexsort((index, block))
            cuts = np.flatnonzero(np.diff(block[order])) + 1
            for mine in np.split(order, cuts):
                n = length[mine]
                total = np.concatenate([[0], np.cumsum(n)])
                where = np.repeat(start[mine] - total[:-1], n) + np.arange(total[-1])
                rows.append((int(block[mine[0]]), pack(np.diff(index[mine], prepend=0)), pack(n), pack(ids[where])))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                names=["block", "idx", "lens", "token_ids"])

        for batch in batches:
            # runs of equal words: a word is encoded when it first appears
            words = batch.column(0).to_pylist()
            found: list[list[int]] = []
            for w in words:
                if w != last:
                    last, last_ids = w, merge_bytes(w, ranks)
                found.append(last_ids)
            blocks.append(batch.column(1).to_numpy())
            idx.append(batch.column(2).to_numpy())
            lens.append(np.fromiter(map(len, found), np.int64, len(found)))
            flat.append(np.fromiter((x for ids in found for x in ids), np.int64))
            held += len(words)
            if held >= flush_rows:
                yield flush()
                blocks, idx, lens, flat, held = [], [], [], [], 0
        if held:
            yield flush()

    return run


def decode_ids(ids: np.ndarray, token: Callable[[int], bytes]) -> bytes:
    """The bytes of token ids: each id is looked up in the token-byte table."""
    return b"".join(map(token, ids.tolist()))


def _assemble(id_kind: pa.DataType, tokens_of):
    """A block and its words' ids -> its documents' ids, in batches of a few MB."""
    kinds = [("id", id_kind), ("n_tokens", pa.int64()), ("ids", pa.binary())] + [("decoded", pa.binary())] * bool(tokens_of)
    schema = pa.schema(kinds)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        words = left.column("n_words")[0].as_py()
        start, length = np.zeros(words, np.int64), np.full(words, -1, np.int64)
        flat, at = [], 0
        for i, n, t in zip(*(right.column(c).to_pylist() for c in ("idx", "lens", "token_ids"))):
            index, n, t = np.cumsum(unpack(i), dtype=np.int64), unpack(n).astype(np.int64), unpack(t)
            start[index] = at + np.cumsum(n) - n
            length[index] = n
            flat.append(t)
            at += len(t)
        if (length < 0).any():
            raise RuntimeError("a pre-token came back without ids")
        tokens = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
        codes = unpack(left.column("codes")[0].as_py())
        token = tokens_of.value.__getitem__ if tokens_of else None
        done, held, rows = [], 0, []
        begin = 0
        for key, end in zip(left.column("ids")[0].as_py(), left.column("ends")[0].as_py()):
            own = codes[begin:end]
            n = length[own]
            total = np.concatenate([[0], np.cumsum(n)])
            ids = tokens[np.repeat(start[own] - total[:-1], n) + np.arange(total[-1])].astype("<u4")
            rows.append((key, len(ids), ids.tobytes(), *([decode_ids(ids, token)] if token else [])))
            begin, held = end, held + len(ids)
            if held >= 1 << 20:
                done.append(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema))
                held, rows = 0, []
        if rows:
            done.append(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema))
        return pa.Table.from_batches(done, schema)

    return run


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text: str = "text",
           block_bytes: int = BLOCK_BYTES, decoded: bool = False) -> DataFrame:
    """(id, n_tokens, ids) per document; ids are little-endian unsigned 32-bit integers.

    With ``decoded`` the ids are decoded again in the same task, as column ``decoded``.
    """
    spark = docs.sparkSession
    ranks = read_ranks(spark, vocabulary)
    shared = spark.sparkContext.broadcast(ranks)
    tokens_of = spark.sparkContext.broadcast({i: b for b, i in ranks.items()}) if decoded else None
    units, tokens = cutter(pattern)
    named = docs.select(F.col(id_col).alias("id"), F.lit(False).alias("flag"), F.col(text).alias("text"))
    blocks = coded_blocks(named, units, tokens, block_bytes)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = (blocks.select("block", F.posexplode("words").alias("idx", "word")).select("word", "block", "idx")
             .repartition(parts, "word").sortWithinPartitions("word"))
    coded = words.mapInArrow(_encode_sorted(shared), "block long, idx binary, lens binary, token_ids binary")
    kind = named.schema["id"].dataType
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]
    left = blocks.select("block", "ids", "ends", "codes", F.size("words").alias("n_words"))
    return left.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(
        _assemble(arrow, tokens_of),
        f"id {kind.simpleString()}, n_tokens long, ids binary" + ", decoded binary" * decoded)


def decode(coded: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``coded`` with the bytes of its ids as ``out``; an unknown id is an error."""
    spark = coded.sparkSession
    shared = spark.sparkContext.broadcast({i: b for b, i in read_ranks(spark, vocabulary).items()})
    coded = without(coded, [out])
    rows = coded.select(F.struct(*[F.col(f"`{c}`") for c in coded.columns]).alias("row"), F.col(ids).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for batch in batches:
            texts = [decode_ids(np.frombuffer(x or b"", "<u4"), token) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["row", out])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, `{out}` binary").select("row.*", f"`{out}`")


def digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    coded = encode(docs.select("doc_id", "text"), vocabulary, pattern, decoded=True)
    return coded.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                   public_tokenizers.PATTERN)
