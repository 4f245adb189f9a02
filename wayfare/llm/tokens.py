"""Token ids of whole texts by the tokenizers library, each distinct chunk encoded once.

The byte-level pre-tokenizer never joins what stands before a blank to what stands after it,
if the blank is followed by a visible character: the blank opens the next piece. Nor does it join
letters, digits, other visible characters and line ends to each other, but for apostrophes. A text may
thus be cut before every such blank and between common characters of these classes, and a chunk's
ids do not depend on its neighbours. Words
repeat: the chunks of many texts are sorted by hash, compared byte by byte with the first
of their hash, and only distinct ones are looked at one by one. A worker keeps the ids of those it has
seen, in a table of bounded length. Ids of texts are put together by index.

New chunks that are a single piece go to the library's model as they are, many at a time; the library
cuts all others.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import compress

import numpy as np

from wayfare.llm.hashing import word_hashes

# Chunks whose ids a worker keeps, and the longest chunk worth keeping.
KEPT_CHUNKS = 250_000
KEPT_BYTES = 64
# Pieces that the library encodes in one call.
JOINED = 2000
# Characters that are cut and looked up together.
GROUP_CHARS = 4_000_000

# First bytes of characters that are visible for certain: no kind of blank begins with them.
_VISIBLE = np.zeros(256, bool)
_VISIBLE[33:127] = True
_VISIBLE[0xC3:0xF5] = True
_VISIBLE[[0xE1, 0xE2, 0xE3]] = False

# Classes of bytes between which texts are cut: letters, digits, others, line ends. 0 is not cut.
_LETTER, _DIGIT, _OTHER, _LINE = 1, 2, 3, 4
_CLASS = np.zeros(256, np.uint8)
_CLASS[33:127] = _OTHER
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[10] = _LINE
_CLASS[39] = 0

# Letters whose class no version of Unicode changes, and chunks that are one piece of them.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"
_ONE_PIECE = re.compile(rf" ?(?:[{_LETTERS}]+|[0-9]+|[!-&(-/:-@\[-`{{-~]+)")


def default_path() -> str:
    from public_tokenizers import path

    return path("byte_bpe_50k.json")


def classes(data: np.ndarray) -> np.ndarray:
    """The class of each byte; 0 for those of characters that are not common."""
    found = _CLASS[data]
    # The letters of two bytes that U+00C0 to U+017F are, but for two signs among them.
    lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC5))
    second = data[lead + 1]
    lead = lead[(data[lead] != 0xC3) | (second != 0x97) & (second != 0xB7)]
    found[lead] = found[lead + 1] = _LETTER
    return found


def chunk_starts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where chunks start in UTF-8 bytes, given where texts start: there, at blanks that
    open a visible character, and between characters of different classes.
    """
    starts = np.zeros(len(data), bool)
    kinds = classes(data)
    starts[1:] = (kinds[1:] != kinds[:-1]) & (kinds[1:] > 0) & (kinds[:-1] > 0)
    # How line ends are cut among themselves depends on what follows, unless there is just one.
    lines = np.flatnonzero(kinds[:-1] == _LINE)
    before = np.where(lines > 0, kinds[lines - 1], 0)
    starts[lines[(before == 0) | (before == _LINE)] + 1] = False
    opens = (data[:-1] == 32) & _VISIBLE[data[1:]]
    # What follows the last byte of a text is another text.
    last = texts[1:] - 1
    opens[last[(last >= 0) & (last < len(opens))]] = False
    starts[:-1] |= opens
    starts[texts[texts < len(data)]] = True
    return np.flatnonzero(starts)


class ChunkCoder:
    """Ids (little-endian unsigned 32-bit) of texts, from a coder of single chunks."""

    def __init__(
        self,
        encode_chunks: Callable[[list[str]], Iterable[bytes]],
        encode_whole: Callable[[str], bytes],
        specials: Iterable[str],
    ):
        self.largest_id = (1 << 32) - 1
        self._encode_chunks = encode_chunks
        self._encode_whole = encode_whole
        self._specials = [text for text in specials if text]
        # What is in use, and the generation before it, from which repeats are taken over.
        self._kept: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        group: list[str] = []
        size = 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= GROUP_CHARS:
                yield from self._encode_group(group)
                group, size = [], 0
        yield from self._encode_group(group)

    def _encode_group(self, texts: list[str]) -> Iterator[bytes]:
        special = [any(mark in text for mark in self._specials) for text in texts]
        said = [b"" if whole else text.encode() for text, whole in zip(texts, special)]
        ids, ends = self._ids(said)
        before = 0
        for text, whole, end in zip(texts, special, ends):
            yield self._encode_whole(text) if whole else ids[before:end].tobytes()
            before = end

    def _ids(self, said: list[bytes]) -> tuple[np.ndarray, list[int]]:
        """Ids of all texts after each other, and where those of each text end."""
        joined = b"".join(said)
        data = np.frombuffer(joined, np.uint8)
        edges = np.cumsum([0, *map(len, said)])
        starts = chunk_starts(data, edges[:-1])
        ends = np.append(starts[1:], len(data))
        first, number = self._distinct(data, starts, ends)
        chunks = [joined[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        found = self._known(chunks)
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        places = np.cumsum(lengths) - lengths
        each = lengths[number]
        after = np.cumsum(each)
        index = np.repeat(places[number] - (after - each), each) + np.arange(after[-1] if len(after) else 0)
        of_text = np.searchsorted(starts, edges[1:])
        return flat[index], np.append(0, after)[of_text].tolist()

    @staticmethod
    def _distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct chunks, by one of their places, and which one each chunk is."""
        keys = word_hashes(data, starts, ends, lanes=1)[0]
        order = np.argsort(keys)
        ordered = keys[order]
        fresh = np.append(True, ordered[1:] != ordered[:-1])[: len(order)]
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(fresh) - 1
        first = order[fresh]
        # Chunks of one hash must be equal; one that is not becomes a distinct one itself.
        model = first[number]
        differs = ends - starts != ends[model] - starts[model]
        sizes = np.minimum(ends - starts, ends[model] - starts[model])
        own = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        unequal = data[own] != data[own + np.repeat(starts[model] - starts, sizes)]
        differs[np.repeat(np.arange(len(starts)), sizes)[unequal]] = True
        wrong = np.flatnonzero(differs)
        number[wrong] = len(first) + np.arange(len(wrong))
        return np.append(first, wrong), number

    def _known(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of chunks, each with the blank that opens it."""
        if len(self._kept) > KEPT_CHUNKS:
            self._kept, self._older = {}, self._kept
        kept, older = self._kept, self._older
        found = list(map(kept.get, chunks))
        new = [k for k, ids in enumerate(found) if ids is None]
        missing = [chunks[k] for k in new]
        again = list(map(older.get, missing))
        fresh = [chunk for chunk, ids in zip(missing, again) if ids is None]
        ids = dict(zip(fresh, self._encode_chunks([chunk.decode() for chunk in fresh])))
        for k, chunk, old in zip(new, missing, again):
            found[k] = ids[chunk] if old is None else old
        kept.update((c, i) for c, i in zip(missing, again) if i is not None)
        kept.update((c, i) for c, i in ids.items() if len(c) <= KEPT_BYTES)
        return found  # type: ignore[return-value]


def _cuts_at_blanks(rules: dict) -> bool:
    """Whether a tokenizer file has the pre-tokenizer that the cutting relies on."""
    before = rules.get("pre_tokenizer") or {}
    return (
        rules.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
        and rules["model"]["type"] == "BPE"
        and not rules["model"].get("dropout")
    )


def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable bytes are themselves, the others follow at 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [byte for byte in range(256) if byte not in printable]
    return {byte: chr(256 + k) for k, byte in enumerate(others)}


_coders: dict[str, ChunkCoder] = {}


def library_coder(path: str) -> ChunkCoder:
    """One coder per worker and file, unused truncation and padding switched off."""
    if path not in _coders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        letters = np.zeros(tokenizer.get_vocab_size(), np.int64)
        for token, number in tokenizer.get_vocab().items():
            letters[number] = len(token)  # one letter per byte

        # The same model without a pre-tokenizer: pieces come in its own alphabet, a line each.
        pieces = Tokenizer(tokenizer.model)
        pieces.pre_tokenizer = pre_tokenizers.Split("\n", "removed")
        alphabet = byte_alphabet() | {0: "\n"}

        def cut_by_bytes(ids: np.ndarray, chunks: list[str]) -> Iterator[bytes]:
            ends = np.cumsum([len(chunk.encode()) for chunk in chunks])
            stops = np.searchsorted(np.cumsum(letters[ids]), ends, side="right")
            data, before = ids.tobytes(), 0
            for stop in (4 * stops).tolist():
                yield data[before:stop]
                before = stop

        def encoded(text: str, by: Tokenizer) -> np.ndarray:
            return np.array(by.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

        def single(chunks: list[str]) -> Iterator[bytes]:
            """Chunks that are one piece each."""
            for at in range(0, len(chunks), JOINED):
                part = chunks[at : at + JOINED]
                said = "\0".join(part)
                if said.isascii():
                    said = said.replace(" ", alphabet[32]).replace("\0", "\n")
                else:
                    said = said.encode().decode("latin-1").translate(alphabet)
                yield from cut_by_bytes(encoded(said, pieces), part)

        def many(chunks: list[str]) -> list[bytes]:
            known = list(map(_ONE_PIECE.fullmatch, chunks))
            ascii_first = sorted(compress(chunks, known), key=str.isascii, reverse=True)
            ids = dict(zip(ascii_first, single(ascii_first)))
            return [ids[chunk] if match else whole(chunk) for chunk, match in zip(chunks, known)]

        def whole(text: str) -> bytes:
            return array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        coder = ChunkCoder(many, whole, added)
        coder.largest_id = max(tokenizer.get_vocab().values(), default=0)
        if not _cuts_at_blanks(rules):
            coder.encode = lambda texts: map(whole, texts)  # type: ignore[method-assign]
        _coders[path] = coder
    return _coders[path]
