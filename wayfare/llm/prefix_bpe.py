"""BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a piece of text exactly one token can be the last of its encoding. An
automaton that matches all tokens ending at a position offers the candidates; a candidate is
the one if the prefix before it is empty, or if the pair (last token of that prefix, candidate)
is compatible: encoding the bytes of both together gives just these two. Back-pointers from the
end of the piece give the ids. No merges are run on texts.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import bounded_batches, sha256_hex, text_of
from wayfare.llm.tokens import ChunkCoder, _cuts_at_blanks, default_path

# Pieces and pairs of tokens that a worker remembers before it starts anew. Of pieces it also
# keeps the generation before, which it looks up next.
KEPT_PIECES = 150_000
KEPT_PAIRS = 1_000_000

# The byte-level pre-tokenizer's pattern, a fixed value of the tokenizer's format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary file.

    Printable Latin-1 characters stand for themselves; the rest follow from U+0100 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {byte: chr(byte) for byte in printable}
    others = (byte for byte in range(256) if byte not in letters)
    letters.update({byte: chr(0x100 + k) for k, byte in enumerate(others)})
    return [letters[byte] for byte in range(256)]


class PrefixCoder:
    """Encoder and decoder of one byte-level BPE vocabulary."""

    def __init__(self, rules: dict):
        if not _cuts_at_blanks(rules):
            raise ValueError("only byte-level BPE vocabularies without a normaliser are supported")
        to_byte = {letter: byte for byte, letter in enumerate(byte_letters())}
        vocab: dict[str, int] = rules["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in rules.get("added_tokens", ())}
        # The bytes of each token as Latin-1 text, which the automaton can hold.
        latin = {
            token: "".join(chr(to_byte[c]) for c in token)
            for token in vocab
            if token not in self.special
        }
        self.bytes_of = {vocab[token]: text.encode("latin-1") for token, text in latin.items()}
        self.bytes_of.update({i: text.encode() for text, i in self.special.items()})
        # Merges by rank: which pair makes which token, and how each token was made.
        self.rank = dict.fromkeys(self.bytes_of, -1)
        self.parts: dict[int, tuple[int, int]] = {}
        self.pair_rank: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(rules["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, made = (vocab[left], vocab[right]), vocab[left + right]
            self.pair_rank[pair] = rank
            self.parts.setdefault(made, pair)
            self.rank[made] = rank
        self.automaton = ahocorasick.Automaton()
        for token, text in latin.items():
            made = vocab[token]
            if len(text) == 1 or made in self.parts:
                self.automaton.add_word(text, (made, len(text)))
        self.automaton.make_automaton()
        self._pairs: dict[tuple[int, int], bool] = {}
        self._pieces: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._pattern = regex.compile(PATTERN)
        marks = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self._special = regex.compile(f"({marks})") if marks else None
        self.chunks = ChunkCoder(
            lambda chunks: map(self.encode_plain, chunks),
            self.encode_text,
            self.special,
        )

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE leaves these two tokens side by side.

        Both are taken apart again, last merge first. At each stage the two tokens at the seam
        were neighbours until the merge just undone took one of them. If merging the two
        comes earlier in the order of merges, BPE would have joined them across the seam. Equal
        merges go from left to right: one inside the left token comes before the seam, one
        inside the right token after it.
        """
        pair = (left, right)
        known = self._pairs.get(pair)
        if known is None:
            if len(self._pairs) > KEPT_PAIRS:
                self._pairs.clear()
            known = self._pairs[pair] = self._seam_holds(left, right)
        return known

    def _seam_holds(self, left: int, right: int) -> bool:
        until, inside_right = len(self.pair_rank), False
        rank = self.rank
        while True:
            across = self.pair_rank.get((left, right))
            if across is not None and (across < until or (across == until and inside_right)):
                return False
            if rank[left] > rank[right]:
                until, inside_right = rank[left], False
                left = self.parts[left][1]
            elif rank[right] >= 0:
                until, inside_right = rank[right], True
                right = self.parts[right][0]
            else:
                return True

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece, which no token may cross."""
        last: list[int] = [-1] * (len(piece) + 1)
        back: list[int] = [0] * (len(piece) + 1)
        compatible = self.compatible
        # Longest first at each end, so the first that fits closes the position.
        for end, (token, length) in self.automaton.iter(piece.decode("latin-1")):
            stop = end + 1
            if last[stop] < 0:
                start = stop - length
                if start == 0 or (last[start] >= 0 and compatible(last[start], token)):
                    last[stop], back[stop] = token, start
        ids = []
        at = len(piece)
        while at:
            ids.append(last[at])
            at = back[at]
        ids.reverse()
        return ids

    def encode_plain(self, text: str) -> bytes:
        """Ids of a text in which special tokens have no meaning."""
        found = []
        if len(self._pieces) > KEPT_PIECES:
            self._pieces, self._older = {}, self._pieces
        kept = self._pieces
        for piece in self._pattern.findall(text):
            ids = kept.get(piece)
            if ids is None and (ids := self._older.get(piece)) is not None:
                kept[piece] = ids
            if ids is None:
                encoded = piece.encode("utf-8", "surrogatepass")
                ids = array("I", self.encode_piece(encoded)).tobytes()
                if len(piece) <= 64:
                    kept[piece] = ids
            found.append(ids)
        return b"".join(found)

    def encode_text(self, text: str) -> bytes:
        """Ids of a text, special tokens included."""
        if self._special is None:
            return self.encode_plain(text)
        parts = self._special.split(text)
        return b"".join(
            array("I", [self.special[part]]).tobytes() if k % 2 else self.encode_plain(part)
            for k, part in enumerate(parts)
        )

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of whole texts, little-endian unsigned 32-bit; chunks that repeat are kept."""
        return self.chunks.encode(texts)

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are not UTF-8 become replacement characters."""
        table = self.bytes_of
        parts = [table[i] for i in memoryview(ids).cast("I")]
        return b"".join(parts).decode("utf-8", "replace")


_coders: dict[str, PrefixCoder] = {}


def prefix_coder(path: str) -> PrefixCoder:
    if path not in _coders:
        with open(path, encoding="utf-8") as file:
            _coders[path] = PrefixCoder(json.load(file))
    return _coders[path]


def encoded(text: Column, path: str | None = None) -> Column:
    """Ids of a text as little-endian unsigned 32-bit integers; null stays null."""
    path = path or default_path()

    @F.pandas_udf("binary")
    def encode(texts: pd.Series) -> pd.Series:
        known = texts.notna()
        found = list(prefix_coder(path).encode(texts[known]))
        return pd.Series(found, index=texts.index[known], dtype=object).reindex(texts.index)

    return encode(text)


def decoded(ids: Column, path: str | None = None) -> Column:
    """The text of ids made by `encoded`; null stays null. Unknown ids are an error."""
    path = path or default_path()

    @F.pandas_udf("string")
    def decode(column: pd.Series) -> pd.Series:
        return column.map(prefix_coder(path).decode, na_action="ignore")

    return decode(ids)


def id_array(ids: Column) -> Column:
    """The ids as an array of long; null stays null."""

    @F.pandas_udf("array<long>")
    def numbers(column: pd.Series) -> pd.Series:
        return column.map(lambda data: np.frombuffer(data, "<u4").astype(np.int64), na_action="ignore")

    return numbers(ids)


def encode_documents(docs: DataFrame, column: str = "ids", path: str | None = None) -> DataFrame:
    """`docs` with the ids of each whole text in a binary column.

    A null text counts as empty and has no ids. Any row order, repeated rows and other columns
    stay as they are; a column that has the name already is replaced.
    """
    bounded_batches(docs.sparkSession)
    return docs.withColumn(column, encoded(text_of(), path))


def round_trip_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: each text encoded, and its ids decoded."""
    path = path or default_path()

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(column: pd.Series) -> pd.DataFrame:
        decode = prefix_coder(path).decode
        rows = [
            (len(ids) // 4, sha256_hex(ids), sha256_hex(decode(ids).encode("utf-8")))
            for ids in column
        ]
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    encoded_docs = encode_documents(read, "_ids", path)
    return encoded_docs.select("doc_id", digests("_ids").alias("_d")).select("doc_id", "_d.*")
