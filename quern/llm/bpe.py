"""Byte-pair encoding by backtracking, and decoding by an offset table.

The encoder runs an Aho-Corasick automaton of all tokens over a piece of text once, which gives the longest token at each position. It
takes longest matches from the left; a token may follow another only if the merges could not join across their border, which a pair table
answers. Where no token fits it steps back and tries the next shorter one. A bit for each position keeps dead ends from being tried again,
so the work is linear in the piece, and the result equals applying the merges by rank.

Cases: a null or empty text has no tokens and decodes to the empty text; strings of special tokens in a text become these tokens, as the
tokenizer file has it; repeated rows each give a row; null ids are passed through.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import tune

#: White space as the pattern means it, and the pattern that splits text into pieces. Alternatives that begin with
#: different characters are put in order of frequency.
WHITE = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
PIECES = rf" ?\p{{L}}+| ?\p{{N}}+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
#: The same for texts whose characters beyond ASCII are all Latin letters of U+00C0 to U+024F; these need no property tables.
LATIN = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-ɏ"
LATIN_PIECES = re.compile(rf" ?[{LATIN}]+| ?[0-9]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\t-\r 0-9{LATIN}]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
NOT_LATIN = re.compile(r"[^\x00-\x1b\x20-\x7f\xc0-\xd6\xd8-\xf6\xf8-ɏ]")

#: Pieces whose encoding a worker keeps, in two generations; beyond it the older one goes.
KEPT_PIECES, KEPT_LENGTH = 250_000, 64


def byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary -> the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}


class Bpe:
    """The vocabulary and merges of a tokenizers file of the byte-level kind."""

    def __init__(self, path: str) -> None:
        spec = json.load(open(path, encoding="utf-8"))
        of = byte_chars()
        raw = lambda token: bytes(of[c] for c in token)
        vocab = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        # ranks: single bytes first, then merges in order; they decide which of two merges comes first
        singles = [bytes([b]) for b in range(256) if bytes([b]) in vocab]
        self.bytes_of = list(singles)
        rank = {b: i for i, b in enumerate(singles)}
        self.split: list[tuple[int, int]] = [(i, i) for i in range(len(singles))]
        self.pairs: dict[tuple[int, int], int] = {}
        for a, b in merges:
            x, y = rank[raw(a)], rank[raw(b)]
            both = self.bytes_of[x] + self.bytes_of[y]
            if both not in rank:
                rank[both] = len(self.bytes_of)
                self.bytes_of.append(both)
                self.split.append((x, y))
            self.pairs.setdefault((x, y), rank[both])
        self.id_of = [vocab[b] for b in self.bytes_of]
        self.auto = ahocorasick.Automaton()
        for r, b in enumerate(self.bytes_of):
            self.auto.add_word(b.decode("latin-1"), r)
        self.auto.make_automaton()
        # the longest token that is a proper prefix of each token
        self.shorter = [next((rank[b[:n]] for n in range(len(b) - 1, 0, -1) if b[:n] in rank), -1) for b in self.bytes_of]
        self.compatible = functools.lru_cache(200_000)(self._compatible)
        # decoding: all tokens' bytes in one run, and where each begins
        table = {i: b for b, i in vocab.items()} | {i: s.encode() for s, i in self.special.items()}
        sizes = [len(table.get(i, b"")) for i in range(max(table) + 1)]
        self.offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(table.get(i, b"") for i in range(max(table) + 1)), np.uint8)
        self.token_bytes = [self.blob[a:b].tobytes() for a, b in itertools.pairwise(self.offsets.tolist())]
        self.names = [str(i) for i in range(len(self.token_bytes))]
        self.sizes = [len(b) for b in self.bytes_of]
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        self.pattern = regex.compile(PIECES)

    def _compatible(self, a: int, b: int) -> bool:
        """Whether no merge crosses the border of a and b before both are whole. The later-made side is taken apart step by step; a pair
        that merges earlier than what was taken apart would have come first."""
        limit = 1 << 60
        while True:
            joined = self.pairs.get((a, b))
            if joined is not None and joined < limit:
                return False
            if a > b:
                limit, a = a, self.split[a][1]
                if a == limit:  # a single byte
                    limit, b = b + 1, self.split[b][0]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, self.split[b][0]
                if b + 1 == limit:
                    limit, a = a, self.split[a][1]
                    if a == limit:
                        return True

    def encode_piece(self, piece: bytes) -> list[int]:
        n, sizes, shorter, compatible = len(piece), self.sizes, self.shorter, self.compatible
        longest = [-1] * n
        for end, r in self.auto.iter(piece.decode("latin-1")):  # by end, so the last of each start is the longest
            longest[end + 1 - sizes[r]] = r
        alive = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0] if n else -1
        while at < n:
            if token < 0:
                raise ValueError("a byte has no token")
            before = out[-1] if out else -1
            while token >= 0:
                end = at + sizes[token]
                if alive[end] and (before < 0 or compatible(before, token)):
                    out.append(token)
                    at = end
                    token = longest[at] if at < n else -1
                    break
                token = shorter[token]
            else:
                alive[at] = 0
                token = out.pop()
                at -= sizes[token]
        return [self.id_of[r] for r in out]

    def pieces(self, text: str) -> list[str]:
        return (self.pattern if NOT_LATIN.search(text) else LATIN_PIECES).findall(text)

    def encode(self, text: str) -> list[int]:
        if self._special and (m := self._special.search(text)):
            return [*self.encode(text[: m.start()]), self.special[m[0]], *self.encode_rest(text, m.end())]
        return self._plain(text)

    def encode_rest(self, text: str, at: int) -> list[int]:
        out: list[int] = []
        for m in self._special.finditer(text, at):
            out += [*self._plain(text[at : m.start()]), self.special[m[0]]]
            at = m.end()
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[int]:
        young, old = self.young, self.old
        out: list[int] = []
        for p in self.pieces(text):
            ids = young.get(p)
            if ids is None:
                ids = old.get(p)
                if ids is None:
                    ids = tuple(self.encode_piece(p.encode("utf-8", "surrogatepass")))
                if len(p) <= KEPT_LENGTH:
                    if len(young) >= KEPT_PIECES:
                        old = self.old = young
                        young = self.young = {}
                    young[p] = ids
            out += ids
        return out

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


@functools.lru_cache(2)
def load(path: str) -> Bpe:
    return Bpe(path)


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id") -> DataFrame:
    """id, ids array<int> of every whole text. tokenizer: a path that every executor has."""
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer)
        for b in batches:
            ids = [np.asarray(bpe.encode(t or ""), np.int32) for t in b["text"].to_pylist()]
            sizes = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([b[id_col].cast(pa.int64()), pa.ListArray.from_arrays(pa.array(sizes), pa.array(values))], [id_col, "ids"])

    return docs.select(id_col, "text").mapInArrow(run, f"{id_col} long, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id") -> DataFrame:
    """id, text from id, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b[id_col], pa.array([bpe.decode(x or []) for x in b["ids"].to_pylist()], pa.string())], [id_col, "text"])

    return encoded.select(id_col, "ids").mapInArrow(run, f"{id_col} long, text string")


def digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The contract's columns: each text is encoded, and its ids are decoded again."""
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer)
        name, sha = bpe.names.__getitem__, lambda x: hashlib.sha256(x).hexdigest()
        for b in batches:
            n, of_ids, of_text = [], [], []
            for text in b["text"]:
                ids = bpe.encode(text.as_py() or "")
                n.append(len(ids))
                of_ids.append(sha(",".join(map(name, ids)).encode()))
                of_text.append(sha(bpe.decode(ids).encode()))
            yield pa.RecordBatch.from_arrays([b["doc_id"].cast(pa.int64()), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def with_ids(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The documents and their ids array<int> and n_tokens; a column of either name is replaced."""
    tune(docs.sparkSession)
    keep = [c for c in docs.columns if c.lower() not in ("ids", "n_tokens")]
    kept = docs.select(*keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer)
        for b in batches:
            ids = [bpe.encode(t or "") for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in keep), pa.array(ids, pa.list_(pa.int32())), pa.array([len(x) for x in ids], pa.int64())], [*keep, "ids", "n_tokens"])

    return kept.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", ids array<int>, n_tokens long")
