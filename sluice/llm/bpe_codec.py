"""BPE encoding and decoding by tree concatenation.

A word (what the vocabulary's split pattern leaves whole) is encoded as a tree:
its halves are encoded on their own, then a window around the join is encoded
again, one token wide on either side at first and growing, until the tokens at
both of its edges agree with their neighbours. A sequence is the encoding of its
text exactly when every adjacent pair of tokens is the encoding of that pair's
text, so checking the window's two edges is enough. Short words are leaves.

Across Spark, a text longer than ``piece_chars`` is cut into pieces that are
encoded in parallel as rows of their own and concatenated per document by the
same join: at white space nothing can merge, and inside a long unsplit run the
two open words are joined through growing windows.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import table, tidy
from sluice.llm.token_counts import Remembered, heap_merge

LEAF = 24
PIECE_CHARS = 1 << 15
FLUSH_BYTES = 8 << 20
#: White space that the split pattern drops (Unicode's White_Space).
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# Letters and numbers of Unicode versions after the tokenizer library's 16.0, which
# it takes for marks, and capitals of 16.0 that Python does not lower yet.
NEWER = (
    r"\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d"
    r"\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a"
    r"\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686"
    r"\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    r"\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168"
    r"\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de"
    r"\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff"
    r"\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
NEWER_CAPITALS = (
    {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
    | {c: c + 0x20 for c in range(0x10D50, 0x10D66)}
    | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
)
#: Control characters that Python's split takes for white space and the pattern does not.
CONTROL = re.compile("[\x1c-\x1f]")
#: Letters of several scripts that stay single letters when lower-cased, and that normalisation
#: never joins with the letter before them.
LETTER = (
    "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f\u0391-\u03a1\u03a3-\u03ce\u0400-\u0481\u048a-\u052f\u05d0-\u05ea"
    "\u0620-\u064a\u0e01-\u0e30\u0e32\u0e33\u0e40-\u0e46\u3041-\u3096\u30a1-\u30fa\u30fc\u4e00-\u9fff\uac00-\ud7a3"
)
#: Where a long run may be cut: after 16 letters (or plain marks) and before one more.
INSIDE = re.compile(f"(?<=[{LETTER}]{{16}})(?=[{LETTER}])|(?<=[=_*#~.-]{{16}})(?=[=_*#~.-])")
#: Where the split pattern parts a run anyway: after a digit and before another, or a letter.
APART = re.compile("(?<=[0-9])(?=[0-9A-Za-z])")
#: Words, and chunks, that a worker remembers; as many again are kept from before the last turn.
REMEMBERED = 100_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where printable, else the next free one from 256."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def _pair(a: int, b: int) -> int:
    return a << 20 | b


class WordBpe:
    """Encoder and decoder of a word-end BPE vocabulary in a tokenizer file."""

    def __init__(self, path: str, leaf: int = LEAF):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.leaf = spec["model"], leaf
        ids = model["vocab"]
        end = model["end_of_word_suffix"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.joined = [ids[a + b] for a, b in merges]
        self.rank = {_pair(ids[a], ids[b]): r for r, (a, b) in enumerate(merges)}
        self.joins = {p: (r, self.joined[r]) for p, r in self.rank.items()}
        letters = byte_letters()
        self.inner = [ids[c] for c in letters]
        self.last = [ids[c + end] for c in letters]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        self.parts: dict[int, list[int]] = {i: [i] for i in (*self.inner, *self.last)}
        for a, b in merges:
            self.parts[ids[a + b]] = self.parts[ids[a]] + self.parts[ids[b]]
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = pattern.replace("\\s", WHITE)
        self.ascii_word = regex.compile(pattern)
        mark = next(part for part in pattern.split("|") if part.startswith("[^"))
        older = pattern.replace(mark, "\0").replace("[\\p{L}]", f"(?:(?![{NEWER}])\\p{{L}})").replace("[\\p{N}]", f"(?![{NEWER}])\\p{{N}}")
        self.word = regex.compile(older.replace("\0", f"(?:{mark[:-1]}|[{NEWER}])+"))
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.words = Remembered(self._word, REMEMBERED)
        self.chunks = Remembered(self._chunk, REMEMBERED)

    # one word

    def _leaf(self, symbols: list[int]) -> list[int]:
        """Lowest rank first, leftmost on ties, until no pair joins."""
        if len(symbols) > 4 * self.leaf:
            return heap_merge(symbols, self.joins, _pair)[0]
        get, joined, none = self.rank.get, self.joined, len(self.joined)
        ranks = [get(a << 20 | b, none) for a, b in zip(symbols, symbols[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            new = symbols[at] = joined[best]
            del symbols[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = get(new << 20 | symbols[at + 1], none)
            if at:
                ranks[at - 1] = get(symbols[at - 1] << 20 | new, none)
        return symbols

    def _agree(self, a: int, b: int) -> bool:
        return self._leaf(self.parts[a] + self.parts[b]) == [a, b]

    def concatenate(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two encoded halves' text."""
        if not left or not right:
            return left or right
        wide = 1
        while True:
            a, b = max(0, len(left) - wide), min(len(right), wide)
            window = self._leaf([s for t in (*left[a:], *right[:b]) for s in self.parts[t]])
            if (a == 0 or self._agree(left[a - 1], window[0])) and (
                b == len(right) or self._agree(window[-1], right[b])
            ):
                return left[:a] + window + right[b:]
            wide *= 2

    def tree(self, symbols: list[int]) -> list[int]:
        if len(symbols) <= self.leaf:
            return self._leaf(symbols)
        # Bottom-up, so that a run of any length needs no deep recursion.
        level = [self._leaf(symbols[i : i + self.leaf]) for i in range(0, len(symbols), self.leaf)]
        while len(level) > 1:
            odd = level[-1:] if len(level) % 2 else []
            level = [self.concatenate(a, b) for a, b in zip(level[::2], level[1::2], strict=False)] + odd
        return level[0]

    def _symbols(self, word: str, closed: bool = True) -> list[int]:
        raw = word.encode()
        symbols = [self.inner[b] for b in raw]
        if closed:
            symbols[-1] = self.last[raw[-1]]
        return symbols

    def _word(self, word: str) -> bytes:
        return np.array(self.tree(self._symbols(word)), "<u4").tobytes()

    # a text without white space

    def split(self, text: str) -> list[str]:
        if text.isascii():
            text = text.lower()
            return [text] if text.isalpha() else self.ascii_word.findall(text)
        text = unicodedata.normalize("NFC", text).translate(NEWER_CAPITALS)
        return self.word.findall("".join([c.lower() for c in text]))

    def items(self, text: str) -> list[str | int]:
        """Words of a text, and the ids of the special strings in it."""
        if "<" not in text:
            return self.split(text)
        out: list[str | int] = []
        for part in self.marks.split(text):
            out += [self.special[part]] if part in self.special else self.split(part)
        return out

    def _ids(self, items: list[str | int]) -> bytes:
        words = self.words
        return b"".join([words[w] if isinstance(w, str) else np.array([w], "<u4").tobytes() for w in items])

    def _chunk(self, chunk: str) -> bytes:
        return self._ids(self.items(chunk))

    # texts

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        chunks = text.split() if not CONTROL.search(text) else re.split("[ \n\t]+", text)
        seen = self.chunks
        return b"".join([seen[c] for c in chunks])

    def encode_piece(self, text: str, open_head: bool, open_tail: bool) -> tuple[bytes, int, int]:
        """A piece of a text: its ids, and how many belong to a word open at its head or tail."""
        if not (open_head or open_tail):
            return self.encode(text), 0, 0
        items = self.items(text)
        if len(items) == 1:
            ids = self.tree(self._symbols(items[0], closed=not open_tail))
            return np.array(ids, "<u4").tobytes(), len(ids) * open_head, len(ids) * open_tail
        head = tail = b""
        if open_head:  # cut inside a run, so the piece starts, or ends, with a plain word
            head = self._word(items.pop(0))
        if open_tail:
            tail = np.array(self.tree(self._symbols(items.pop(), closed=False)), "<u4").tobytes()
        return head + self._ids(items) + tail, len(head) // 4, len(tail) // 4

    def join_pieces(self, pieces: list[tuple[bytes, int, int]]) -> bytes:
        """Concatenate a document's encoded pieces, in order, pairwise as a tree."""
        level = [(np.frombuffer(b, "<u4").tolist(), h, t) for b, h, t in pieces]
        while len(level) > 1:
            odd = level[-1:] if len(level) % 2 else []
            level = [self._join_pair(a, b) for a, b in zip(level[::2], level[1::2], strict=False)] + odd
        return np.array(level[0][0], "<u4").tobytes()

    def _join_pair(self, a, b):
        (left, left_head, left_tail), (right, right_head, right_tail) = a, b
        if not left_tail:
            return left + right, left_head, right_tail
        cut = len(left) - left_tail
        middle = self.concatenate(left[cut:], right[:right_head])
        head = left_head if cut else len(middle) * bool(left_head)
        tail = right_tail if right_head < len(right) else len(middle) * bool(right_tail)
        return left[:cut] + middle + right[right_head:], head, tail

    def forget(self) -> None:
        """Free what the task has remembered; the vocabulary stays."""
        self.words.forget()
        self.chunks.forget()

    def decode(self, ids: bytes) -> str:
        """The tokens' strings joined by spaces, as the file (which names no decoder) asks."""
        return " ".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def cut_text(text: str, size: int) -> list[tuple[str, bool, bool]]:
    """Pieces of about ``size`` characters: (piece, open at its head, open at its tail).

    Cuts fall before white space or, failing that, between digits or inside a run of 16
    and more letters of any of the scripts of LETTER; where none is found a piece stays longer.
    """
    pieces, start, opened = [], 0, False
    white = re.compile("[ \n\t]")
    while len(text) - start > size:
        at = max(text.rfind(c, start + 1, start + size) for c in " \n\t")
        glued = False
        if at < 0:
            inner = INSIDE.search(text, start + size)
            outer = white.search(text, start + size)
            apart = APART.search(text, start + size)
            found = min((m.start() for m in (inner, outer, apart) if m), default=-1)
            if found < 0:
                break
            glued = bool(inner and inner.start() == found)  # white space and digits are in no letter run
            at = found
        pieces.append((text[start:at], opened, glued))
        start, opened = at, glued
    pieces.append((text[start:], opened, False))
    return pieces


@lru_cache(maxsize=2)
def codec(path: str) -> WordBpe:
    return WordBpe(path)


def encode_texts(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    piece_chars: int = PIECE_CHARS,
) -> DataFrame:
    """One row per input row: id, n_tokens, ids (little-endian uint32 bytes), decoded.

    Whole texts are encoded, special strings inside them as their own ids, none
    added. Null and empty texts give no ids and an empty decoded text. Repeated
    rows and null ids give a row each; other columns are ignored; an empty table
    gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    result = rows.select(
        "id", F.lit(0).cast("long").alias("n_tokens"), F.lit(None).cast("binary").alias("ids"), F.lit("").alias("decoded")
    ).schema
    result = type(result)([type(f)(f.name, f.dataType, True) for f in result])

    def whole(batches):
        bpe = codec(tokenizer_path)
        for batch in batches:
            at, texts = 0, batch.column("t")
            while at < len(texts):
                ids, decoded, held, first = [], [], 0, at
                while at < len(texts) and held < FLUSH_BYTES:
                    ids.append(bpe.encode(texts[at].as_py()))
                    decoded.append(bpe.decode(ids[-1]))
                    held += len(ids[-1]) + len(decoded[-1])
                    at += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(first, at - first),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array(decoded, pa.string()),
                    ],
                    names=result.names,
                )
        bpe.forget()

    short = rows.where(F.length("t") <= piece_chars).mapInArrow(tidy(whole), result)

    cut = rows.where(F.length("t") > piece_chars).withColumn("row", F.monotonically_increasing_id())
    id_type = rows.schema["id"].dataType.simpleString()

    def pieces(frames):
        for frame in frames:
            for row, i, text in zip(frame["row"], frame["id"], frame["t"], strict=True):
                parts = cut_text(text, piece_chars)
                yield pd.DataFrame({
                    "row": row, "id": pd.Series([i] * len(parts), dtype=object), "n": range(len(parts)),
                    "piece": [p for p, _, _ in parts], "head": [h for _, h, _ in parts], "tail": [t for _, _, t in parts],
                })

    def encode_pieces(frames):
        bpe = codec(tokenizer_path)
        for frame in frames:
            done = [
                bpe.encode_piece(p, h, t) for p, h, t in zip(frame["piece"], frame["head"], frame["tail"], strict=True)
            ]
            yield pd.DataFrame({
                "row": frame["row"], "id": frame["id"], "n": frame["n"], "ids": [d[0] for d in done],
                "n_head": [d[1] for d in done], "n_tail": [d[2] for d in done],
            })
        bpe.forget()

    def concatenate(group: pd.DataFrame) -> pd.DataFrame:
        bpe = codec(tokenizer_path)
        group = group.sort_values("n")
        ids = bpe.join_pieces(list(zip(group["ids"], group["n_head"], group["n_tail"], strict=True)))
        return pd.DataFrame({
            "id": group["id"].iloc[:1].astype(object), "n_tokens": [len(ids) // 4], "ids": [ids], "decoded": [bpe.decode(ids)],
        })

    long = (
        cut.mapInPandas(pieces, f"row long, id {id_type}, n int, piece string, head boolean, tail boolean")
        .repartition("row", "n")
        .mapInPandas(tidy(encode_pieces), f"row long, id {id_type}, n int, ids binary, n_head long, n_tail long")
        .groupBy("row")
        .applyInPandas(concatenate, result)
    )
    return short.unionByName(long).withColumnRenamed("id", id_col)


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest(encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def digest(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
