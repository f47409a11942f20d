"""Byte-level BPE: texts to token ids and back, by segment trees over adjacent pair ranks.

The leaves of a tree hold, for each token of a word, the rank of its pair with the next token.
The root is the smallest of (rank, place), which is the leftmost merge of the lowest rank. A
merge changes three leaves, and each change climbs to the root, so a word of n bytes takes at
most n merges of logarithmic cost. Short words are kept in one table of trees per width and
merged together, one root each per step; a few long ones get a tree each.
"""

from __future__ import annotations

import functools
import itertools
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationcast.llm.chunks import ChunkCoder
from stationcast.llm.tables import documents, give_back, id_text, map_slices, slices

# Fixed value: where the pre-tokeniser of the vocabulary cuts a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

NO_MERGE = np.int64(1) << np.int64(62)
# Fewer words of a width than this get a tree each; cells of a table of trees at most.
FEW, CELLS = 12, 1 << 18


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if printable, else the next one from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


class MergeTree:
    """The segment tree of one word."""

    def __init__(self, tokens: list[int], merges: dict[tuple[int, int], tuple[int, int]]):
        self.merges, self.tokens, n = merges, tokens, len(tokens)
        self.width = 1 << max(0, n - 1).bit_length()
        self.after, self.before = [*range(1, n + 1)], [*range(-1, n - 1)]
        self.tree = [(1 << 62, 0)] * (2 * self.width)
        for i in range(n - 1):
            self.tree[self.width + i] = self._pair(i)
        for i in range(self.width - 1, 0, -1):
            self.tree[i] = min(self.tree[2 * i], self.tree[2 * i + 1])

    def _pair(self, i: int) -> tuple[int, int]:
        j = self.after[i]
        if j >= len(self.tokens):
            return (1 << 62, i)
        return (self.merges.get((self.tokens[i], self.tokens[j]), (1 << 62,))[0], i)

    def _set(self, i: int, value: tuple[int, int]) -> None:
        tree, i = self.tree, self.width + i
        tree[i] = value
        while i > 1:
            i >>= 1
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

    def run(self) -> list[int]:
        """Merge until no pair is left that can be; the tokens that remain."""
        n = len(self.tokens)
        while n > 1 and (root := self.tree[1])[0] < 1 << 62:
            i = root[1]
            j = self.after[i]
            self.tokens[i] = self.merges[self.tokens[i], self.tokens[j]][1]
            self.after[i] = self.after[j]
            if self.after[j] < n:
                self.before[self.after[j]] = i
            self._set(j, (1 << 62, j))
            self._set(i, self._pair(i))
            if self.before[i] >= 0:
                self._set(self.before[i], self._pair(self.before[i]))
        out, i = [], 0
        while i < n:
            out.append(self.tokens[i])
            i = self.after[i]
        return out


class ByteBpe:
    """A byte-level BPE vocabulary file, with the library's ids for any text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.merges = {
            (vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)
        }
        self.byte_ids = np.array([vocab[letters[b]] for b in range(256)], dtype=np.int64)
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        keys = np.array([a * self.size + b for a, b in self.merges], dtype=np.int64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.merged = np.array([new for _, new in self.merges.values()], dtype=np.int64)
        self.bytes_of: list[bytes] = [b""] * self.size
        numbers = {letter: b for b, letter in letters.items()}
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(numbers[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.find = regex.compile(PATTERN).findall
        self.coder = ChunkCoder(self.encode_strings)
        # Reading the file took several times the memory that is kept.
        give_back()

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or ``NO_MERGE``."""
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.order[at], NO_MERGE)

    def _merge_table(self, words: list[bytes], width: int) -> list[bytes]:
        """Ids of words of at most ``width`` bytes, a power of two, merged together."""
        count, side = len(words), width + 1
        sizes = np.fromiter(map(len, words), np.int64, count)
        filled = np.arange(side)[None, :] < sizes[:, None]
        tokens = np.zeros((count, side), np.int64)
        tokens[filled] = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        after = np.tile(np.arange(1, side + 1), (count, 1))
        before = np.tile(np.arange(-1, width), (count, 1))
        tree = np.full((count, 2 * width), NO_MERGE, np.int64)
        paired = filled[:, 1:]
        ranks = self._ranks(tokens[:, :-1][paired], tokens[:, 1:][paired])
        places = np.broadcast_to(np.arange(width), (count, width))[paired]
        tree[:, width:][paired] = np.where(ranks < NO_MERGE, ranks * width + places, NO_MERGE)
        level = width >> 1
        while level:
            pairs = tree[:, 2 * level : 4 * level]
            tree[:, level : 2 * level] = np.minimum(pairs[:, 0::2], pairs[:, 1::2])
            level >>= 1
        tokens, after, before, tree, alive = (
            x.reshape(-1) for x in (tokens, after, before, tree, filled.copy())
        )

        def climb(roots: np.ndarray, leaf: np.ndarray) -> None:
            node = width + leaf
            while node[0] > 1:
                node = node >> 1
                child = roots + 2 * node
                tree[roots + node] = np.minimum(tree[child], tree[child + 1])

        def put(rows: np.ndarray, place: np.ndarray, right: np.ndarray) -> None:
            """Set the leaves of the tokens at ``place`` and ``right``, and climb."""
            inside = right < sizes[rows]
            key = np.full(len(rows), NO_MERGE, np.int64)
            r, p, q = rows[inside], place[inside], right[inside]
            ranks = self._ranks(tokens[r * side + p], tokens[r * side + q])
            key[inside] = np.where(ranks < NO_MERGE, ranks * width + p, NO_MERGE)
            roots = rows * (2 * width)
            tree[roots + width + place] = key
            climb(roots, place)

        rows = np.arange(count)
        while True:
            root = tree[rows * (2 * width) + 1]
            going = root < NO_MERGE
            rows, root = rows[going], root[going]
            if not len(rows):
                break
            place = root % width
            cell = rows * side + place
            right = after[cell]
            beyond = after[rows * side + right]
            tokens[cell] = self.merged[root // width]
            after[cell] = beyond
            alive[rows * side + right] = False
            behind = beyond < side
            before[(rows * side + beyond)[behind]] = place[behind]
            gone = rows * (2 * width)
            tree[gone + width + right] = NO_MERGE
            climb(gone, right)
            put(rows, place, beyond)
            prior = before[cell]
            has = prior >= 0
            if has.any():
                put(rows[has], prior[has], place[has])
        kept = alive.reshape(count, side)
        ids = tokens.reshape(count, side)[kept].astype(np.uint32).tobytes()
        ends = (4 * np.cumsum(kept.sum(axis=1))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def merge_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, none of which is empty, as unsigned 32-bit integers."""
        out = [b""] * len(words)
        widths: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            widths.setdefault(max(2, 1 << (len(word) - 1).bit_length()), []).append(i)
        for width, places in widths.items():
            step = max(1, CELLS // (2 * width))
            if min(step, len(places)) < FEW:
                for i in places:
                    tokens = [int(self.byte_ids[b]) for b in words[i]]
                    out[i] = np.array(MergeTree(tokens, self.merges).run(), np.uint32).tobytes()
                continue
            for k in range(0, len(places), step):
                some = places[k : k + step]
                for i, ids in zip(some, self._merge_table([words[i] for i in some], width), strict=True):
                    out[i] = ids
        return out

    def encode_strings(self, strings: list[str]) -> list[bytes]:
        """Ids of each string as the bytes of unsigned 32-bit integers."""
        number: dict[str, int] = {}
        plans: list[int | list[int]] = []
        place = number.setdefault
        for string in strings:
            # One run of letters behind a blank or at the start is a word as it is.
            if (string[1:] if string[:1] == " " else string).isalpha():
                plans.append(place(string, len(number)))
                continue
            plan: list[int] = []
            parts = self.cut.split(string) if "<" in string and self.special else (string,)
            for part in parts:
                if part in self.special:
                    plan.append(-1 - self.special[part])
                else:
                    plan += [place(word, len(number)) for word in self.find(part)]
            plans.append(plan)
        coded = self.merge_words([w.encode() for w in number])
        # A special token has a negative number and so counts from the end of this list.
        table = [*coded, *[b""] * self.size]
        for i in self.special.values():
            table[-1 - i] = np.uint32(i).tobytes()
        return [
            table[plan] if isinstance(plan, int) else b"".join([table[p] for p in plan])
            for plan in plans
        ]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@functools.cache
def load(path: str) -> ByteBpe:
    """One vocabulary per process and path."""
    return ByteBpe(path)


def _with_column(
    df: DataFrame, name: str, kind: str, make: Callable[[pa.Array], pa.Array], column: str
) -> DataFrame:
    """``df`` with a column made from slices of its rows by their ``column``."""
    rest = [c for c in df.columns if c not in (name, column)]
    given = df.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{column}`"))
    passed = given.columns if column != name else rest
    fields = [given.schema[c] for c in passed]
    schema = T.StructType([*fields, T.StructField(name, T._parse_datatype_string(kind))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, column):
            columns = [piece.column(i) for i in range(len(passed))]
            yield pa.RecordBatch.from_arrays([*columns, make(piece.column(column))], [*passed, name])

    return given.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` with a column of the token ids of each whole text.

    A null or empty text has no ids. The string of a special token in a text becomes that
    token, as the tokenizers library does it. Rows, ties and other columns pass through; a
    column named as ``ids`` is replaced. A very long text is a batch by itself.
    """

    def token_ids(texts: pa.Array) -> pa.Array:
        flat, bounds = load(path).coder.encode(texts.fill_null(""))
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat.view(np.int32)))

    typed = docs.withColumn(text, F.col(f"`{text}`").cast("string"))
    return _with_column(typed, ids, "array<int>", token_ids, text)


def decode(tokens: DataFrame, path: str, ids: str = "token_ids", text: str = "text") -> DataFrame:
    """``tokens`` with a column of the text of each row's ids, special tokens written out.

    No ids, or null, give the empty text; bytes that are no UTF-8 become U+FFFD. A column named
    as ``text`` is replaced.
    """

    def texts(rows: pa.Array) -> pa.Array:
        bpe, sizes = load(path), pc.fill_null(pc.list_value_length(rows), 0).to_pylist()
        flat, at, made = rows.flatten().to_numpy(zero_copy_only=False).tolist(), 0, []
        for size in sizes:
            made.append(bpe.decode(flat[at : at + size]))
            at += size
        return pa.array(made, pa.string())

    return _with_column(tokens, text, "string", texts, ids)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def round_trip(docs: DataFrame, path: str, remember: bool = True) -> DataFrame:
    """``doc_id``, ``token_ids`` and the ``text`` these decode to, for every whole text.

    As ``encode`` and then ``decode``, in one Python task instead of two side by side. Where other
    work shares the processes, ``remember`` lets them forget vocabulary and chunks at the end of
    each task and take fewer texts at once, which costs time and saves memory.
    """

    def both(batch: pa.RecordBatch) -> dict:
        bpe = load(path)
        flat, bounds = bpe.coder.encode(batch.column("text"))
        listed, edges = flat.tolist(), bounds.tolist()
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat.view(np.int32)))
        texts = [bpe.decode(listed[a:b]) for a, b in itertools.pairwise(edges)]
        return {"doc_id": batch.column("doc_id"), "token_ids": lists, "text": pa.array(texts, pa.string())}

    schema = "doc_id long, token_ids array<int>, text string"
    if remember:
        return map_slices(id_text(docs), both, schema)
    return map_slices(id_text(docs), both, schema, after=load.cache_clear, most=1 << 19)


def digests(docs: DataFrame, path: str, keep_ids: bool = False, remember: bool = True) -> DataFrame:
    """Per document the number of ids, and checksums of the ids and of what they decode to.

    ``keep_ids`` adds the ids themselves as ``token_ids``.
    """
    return round_trip(docs, path, remember).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
        *(["token_ids"] if keep_ids else []),
    )


def op5_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir), vocabulary())
