"""Edit-aware token counts: a segment tree per document, of which an edit re-encodes a small part.

A text is cut into leaves at single spaces between two characters that are not white space; there a
pre-token begins whatever surrounds it, so the tokens of a text are those of its leaves. A tree holds
the characters and tokens of each subtree. An edit touches some leaves; these and one leaf on either
side (whose inner borders the edit can't move) are cut anew and encoded, and only the sums above them
change. A text without such a space is one leaf. The leaves are kept with the text, so a later edit builds the
tree from them and encodes nothing else.

Defined cases: null text counts as empty (no tokens); places beyond the end mean the end; null or
missing edits change nothing; edits of a document apply in order, each to the result of the one
before; leaves that are not those of the text (their characters don't add up) are made anew; other columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dnsight.llm import words as W
from dnsight.llm.tokens import Encoder

#: Characters of a leaf, at least, where the text has places to cut.
LEAF = 192

EDITS = "array<struct<start:long,removed:long,inserted:string>>"
_CUT = re.compile(r"(?<=\S) (?=\S)")


def leaves(text: str) -> list[str]:
    """The text in leaves of LEAF characters or a little more."""
    found, start = [], 0
    while len(text) - start > LEAF:
        border = _CUT.search(text, start + LEAF)
        if border is None:
            break
        found.append(text[start: border.start()])
        start = border.start()
    return [*found, text[start:]]


class Tree:
    """Sums of characters and tokens over leaves, as a binary tree in an array."""

    def __init__(self, texts: list[str], tokens: list[int]):
        self.width = 1 << max(len(texts) - 1, 0).bit_length()
        self.texts = texts + [""] * (self.width - len(texts))
        self.used = len(texts)
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        self.sums[self.width: self.width + len(texts), 0] = [len(t) for t in texts]
        self.sums[self.width: self.width + len(texts), 1] = tokens
        level = self.width
        while level > 1:
            self.sums[level // 2: level] = self.sums[level: 2 * level].reshape(-1, 2, 2).sum(axis=1)
            level //= 2

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a place, and where that leaf begins."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if place >= begin + self.sums[node, 0] and self.sums[node + 1, 0]:
                begin += int(self.sums[node, 0])
                node += 1
        return node - self.width, begin

    def replace(self, low: int, high: int, texts: list[str], tokens: list[int]) -> None:
        """Give the leaves from low to high new contents; the last takes what has no leaf of its own."""
        room = high - low + 1
        if len(texts) > room:
            texts = [*texts[: room - 1], "".join(texts[room - 1:])]
            tokens = [*tokens[: room - 1], sum(tokens[room - 1:])]
        texts, tokens = texts + [""] * (room - len(texts)), tokens + [0] * (room - len(tokens))
        self.texts[low: high + 1] = texts
        self.sums[self.width + low: self.width + high + 1] = [(len(t), n) for t, n in zip(texts, tokens)]
        a, z = (self.width + low) // 2, (self.width + high) // 2
        while a:
            self.sums[a: z + 1] = self.sums[2 * a: 2 * z + 2].reshape(-1, 2, 2).sum(axis=1)
            a, z = a // 2, z // 2

    def edit(self, start: int, removed: int, inserted: str, count) -> int:
        """Replace characters; returns how many were encoded again."""
        start = min(max(start, 0), self.chars)
        end = min(start + max(removed, 0), self.chars)
        low, begin = self.leaf_at(start)
        high, _ = self.leaf_at(end)
        # A leaf without characters gives no context: go on to one that has some.
        low, high = max(low - 1, 0), min(high + 1, self.used - 1)
        while low > 0 and not self.texts[low]:
            low -= 1
        while high < self.used - 1 and not self.texts[high]:
            high += 1
        first, _ = self.leaf_at(start)
        begin -= sum(len(t) for t in self.texts[low:first])
        region = "".join(self.texts[low: high + 1])
        region = region[: start - begin] + inserted + region[end - begin:]
        parts = leaves(region)
        self.replace(low, high, parts, [count(p) for p in parts])
        return len(region)


def _rows(docs: DataFrame, edits: str, added: list[str]) -> tuple[DataFrame, list]:
    """The columns that are kept, the text, the edits, and the stored leaves or null; and the kept fields."""
    own = {a.split()[0] for a in added} | {"text", "leaf_chars", "leaf_tokens", edits}
    kept = [f for f in docs.schema.fields if f.name not in own]
    held = {"leaf_chars", "leaf_tokens"} <= set(docs.columns)
    lists = [
        (F.col(c) if held else F.lit(None)).cast("array<int>").alias(f"__{c}") for c in ("leaf_chars", "leaf_tokens")
    ]
    changes = (F.col(edits) if edits in docs.columns else F.lit(None)).cast(EDITS).alias("__edits")
    text = F.col("text").cast("string").alias("__text")
    return docs.select(*[F.col(f"`{f.name}`") for f in kept], text, changes, *lists), kept


def _tree(text: str, chars: list[int] | None, tokens: list[int] | None, count) -> Tree:
    """The tree of a text: from its stored leaves, if they are leaves of it, else by encoding all of it."""
    if chars is not None and tokens is not None and sum(chars) == len(text) and len(chars) == len(tokens) > 0:
        ends = np.cumsum(chars).tolist()
        return Tree([text[z - n: z] for z, n in zip(ends, chars)], tokens)
    parts = leaves(text)
    return Tree(parts, [count(p) for p in parts])


def _worked(docs: DataFrame, tokenizer: str, edits: str, added: list[str], result) -> DataFrame:
    """The kept columns and `added`, which `result` gives for a text, its tree before and after, and encoded characters."""
    rows, kept = _rows(docs, edits, added)
    names = [a.split()[0] for a in added]
    kinds = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    types = [kinds[a.split()[1]] for a in added]

    def work(batches: Iterator[pa.RecordBatch]):
        encoder = Encoder(tokenizer)
        count = lambda text: len(encoder.ids(text))
        for batch in batches:
            for part in W.slices(batch, "__text"):
                out = []
                columns = [part.column(c).to_pylist() for c in ("__text", "__edits", "__leaf_chars", "__leaf_tokens")]
                for text, changes, chars, tokens in zip(*columns):
                    tree = _tree(text or "", chars, tokens, count)
                    before, encoded = (tree.chars, tree.tokens, tree.sums[tree.width: tree.width + tree.used].copy()), 0
                    for change in changes or []:
                        if change is not None:
                            encoded += tree.edit(
                                change["start"] or 0, change["removed"] or 0, change["inserted"] or "", count
                            )
                    out.append(result(before, tree, encoded))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(f.name) for f in kept], *[pa.array(list(c), k) for c, k in zip(zip(*out), types)]],
                    [*[f.name for f in kept], *names],
                )

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], *added])
    return rows.mapInArrow(work, schema)


def update_counts(docs: DataFrame, tokenizer: str, edits: str = "edits") -> DataFrame:
    """Adds n_chars, n_tokens, n_leaves, edited_n_chars, edited_n_tokens, reencoded_chars, leaf_chars, leaf_tokens.

    `edits` names a column of type EDITS. Where the documents hold `leaf_chars` and `leaf_tokens`, as
    `apply_edits` returns them, only what the edits touch is encoded; other texts are encoded whole.
    """
    added = [
        "n_chars long", "n_tokens long", "n_leaves long", "edited_n_chars long", "edited_n_tokens long",
        "reencoded_chars long", "leaf_chars array<int>", "leaf_tokens array<int>",
    ]

    def result(before, tree, encoded):
        chars, tokens, sums = before
        return chars, tokens, len(sums), tree.chars, tree.tokens, encoded, sums[:, 0], sums[:, 1]

    return _worked(docs, tokenizer, edits, added, result)


def apply_edits(docs: DataFrame, tokenizer: str, edits: str = "edits") -> DataFrame:
    """The documents with edited `text`, and n_chars, n_tokens, reencoded_chars, leaf_chars, leaf_tokens of it.

    The leaves are the document's tree: stored with the text, the next call takes them from there and
    encodes only what its edits touch. Without a column of edits it makes the trees.
    """
    added = [
        "text string", "n_chars long", "n_tokens long", "reencoded_chars long", "leaf_chars array<int>", "leaf_tokens array<int>",
    ]

    def result(before, tree, encoded):
        sums = tree.sums[tree.width: tree.width + tree.used]
        sums = sums[sums[:, 0] > 0] if tree.chars else sums[:1]
        return "".join(tree.texts), tree.chars, tree.tokens, encoded, sums[:, 0], sums[:, 1]

    return _worked(docs, tokenizer, edits, added, result)


def token_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and n_tokens of every row."""
    none = F.lit(None).cast(EDITS)
    return update_counts(docs.select("doc_id", "text", none.alias("edits")), tokenizer).select("doc_id", "n_tokens")
