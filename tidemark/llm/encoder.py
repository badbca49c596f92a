"""Token ids of Arrow text batches, by the tokenizers library.

Some tokenizers drop white space and lower-case; their pre-tokenizer cuts every other text into runs
of letters, single digits and runs of other signs.  For those, the ids of a text are the ids of
its pieces, one after the other, and every distinct piece is encoded once: pieces are found and told
apart by 64-bit hashes of their bytes, without a string per piece.  Words with an apostrophe (the
pre-tokenizer knows contractions), a control character, anything beyond ASCII and the Latin letters
up to U+017F, or a special string that counts as one are a piece each.  A worker remembers pieces
up to a bound.

Whether a tokenizer is of that kind is read from its file.  With any other, whole texts are
encoded.  ``tests/llm`` compares both with encoding whole texts.
"""

from __future__ import annotations

import contextlib
import ctypes
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.arrays import LOWER, byte_hashes, expanded, raw

# Pieces a worker remembers (some 40 bytes each) before it starts afresh.
REMEMBERED = 400_000
# Bytes of text handled at once, so that memory does not follow the size of Arrow's batches.
SLICE_BYTES = 1 << 20
# The normaliser and pre-tokenizer for which pieces can be encoded one by one.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Kinds of bytes.
_SPACE, _LETTER, _DIGIT, _SIGN, _ODD = range(5)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[33:127] = _SIGN
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[48:58] = _DIGIT
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[ord("'")] = _ODD


def _kinds(data: np.ndarray) -> np.ndarray:
    """Kind of each byte; both bytes of a Latin letter from U+00C0 to U+017F are letters, but for the
    two signs among them and the one letter whose lower case is two characters."""
    kind = _KIND[data]
    lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC5))
    pair = data[lead].astype(np.uint16) << 8 | data[lead + 1]
    lead = lead[(pair != 0xC397) & (pair != 0xC3B7) & (pair != 0xC4B0)]
    kind[lead] = kind[lead + 1] = _LETTER
    return kind


def _byte_characters() -> str:
    """The characters by which byte-level models write bytes: printable ones write themselves, the
    others, in order, the characters from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in printable else next(others)) for b in range(256))


_BYTES = _byte_characters()


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, stop - at)
            at = stop
    give_back()


def give_back() -> None:
    """Return free memory to the system: workers outlive their tasks, and several share a machine."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)  # in glibc only


def cuts_words(path: str) -> bool:
    """Whether the tokenizer in the file drops white space and cuts words as described above."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    normalizer, cutter = parts.get("normalizer") or {}, parts.get("pre_tokenizer") or {}
    split, *rest = cutter.get("pretokenizers") or [{}]
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
    return (
        normalizer.get("normalizers") == _NORMALIZERS
        and split == {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True}
        and len(rest) == 1
        and plain.items() <= rest[0].items()
        and parts["model"]["type"] == "BPE"
        and not parts["model"].get("dropout")
        and not any(t.get("normalized") or t.get("single_word") for t in parts.get("added_tokens", []))
    )


class WordEncoder:
    """Encodes texts piece by piece where the tokenizer allows; one per worker, tokenizer file and
    treatment of special strings."""

    def __init__(self, path: str, special_is_text: bool, remembered: int | None = None):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_is_text
        self.by_piece = cuts_words(path)
        self.specials = [] if special_is_text else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.remembered = remembered or REMEMBERED
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # hashes, ascending
        self.starts = np.zeros(0, np.int64)  # of each piece's ids in ...
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    @staticmethod
    def of_worker(path: str, special_is_text: bool = False, remembered: int | None = None) -> "WordEncoder":
        """The encoder this worker already has; it outlives the task, as the module does."""
        import tokenizers

        kept = vars(tokenizers).setdefault("_kept_word_encoders", {})
        if (path, special_is_text) not in kept:
            kept[path, special_is_text] = WordEncoder(path, special_is_text, remembered)
        return kept[path, special_is_text]

    def _pieces(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and hashes of all pieces, and the bytes that the hashes are of."""
        kind = _kinds(data)
        inside = kind != _SPACE
        word = inside.copy()  # where a word begins
        word[1:] &= ~inside[:-1]
        heads = bounds[:-1][np.diff(bounds) > 0]
        word[heads] = inside[heads]
        first = np.flatnonzero(word)
        if not len(first):
            return first, first, np.zeros(0, np.uint64), data
        odd = np.logical_or.reduceat(kind == _ODD, first)
        # A run ends where the kind changes; digits stand alone.
        start = inside.copy()
        start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        start[first] = True
        # Spaces between words belong to nobody, so spans to the next word do no harm.
        spans = np.diff(np.append(first, len(data)))
        for at in self._specials(data):
            odd[np.searchsorted(first, at, side="right") - 1] = True
        whole = np.repeat(odd, spans)
        start[first[0] :] &= ~whole | word[first[0] :]
        lowered = LOWER[data]
        lowered[first[0] :][whole] = data[first[0] :][whole]
        starts = np.flatnonzero(start)
        lengths = np.add.reduceat(inside, starts, dtype=np.int64)
        return starts, starts + lengths, byte_hashes(lowered[inside], lengths), lowered

    def _specials(self, data: np.ndarray) -> list[int]:
        found, buffer = [], data.tobytes() if self.specials else b""
        for special in self.specials:
            at = buffer.find(special.encode())
            while at >= 0:
                found.append(at)
                at = buffer.find(special.encode(), at + 1)
        return found

    def _learn(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, lowered: np.ndarray) -> None:
        """Encode pieces that are not known yet."""
        buffer, tokenize = lowered.tobytes(), self.tokenizer.model.tokenize
        # Letters go to the model at once; other pieces pass all of the tokenizer.
        letters = np.concatenate([[0], np.cumsum(_kinds(lowered) == _LETTER)])
        plain = letters[ends] - letters[starts] == ends - starts
        flat: list[int] = []
        lengths = np.zeros(len(hashes), np.int64)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        cut = int(plain.sum())
        spans = zip(starts[order].tolist(), ends[order].tolist())
        texts = [buffer[a:b].decode() for a, b in spans]
        sizes = []
        for text in texts[:cut]:
            tokens = tokenize(text if text.isascii() else text.lower().encode().decode("latin-1").translate(_BYTES))
            sizes.append(len(tokens))
            flat += [t.id for t in tokens]
        for e in self.tokenizer.encode_batch_fast(texts[cut:], add_special_tokens=False) if texts[cut:] else ():
            ids = e.ids
            sizes.append(len(ids))
            flat += ids
        lengths[order] = sizes
        begins = np.zeros(len(hashes), np.int64)
        begins[order] = np.cumsum(sizes) - sizes + len(self.ids)
        self.ids = np.concatenate([self.ids, np.array(flat, np.uint32)])
        # ``hashes`` ascend, as the known ones do.
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.starts = np.insert(self.starts, at, begins)
        self.lengths = np.insert(self.lengths, at, lengths)

    def _place(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash among the known ones, and whether it is there."""
        if not len(self.known):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return at, self.known[at] == hashes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text (NULL: 0), and all ids in a row."""
        if not self.by_piece:
            return self._encode_whole(texts)
        data, bounds = raw(texts)
        starts, ends, hashes, lowered = self._pieces(data, bounds)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        at, found = self._place(distinct)
        if len(self.known) + int((~found).sum()) > self.remembered:
            self._forget()
            found[:] = False
        if not found.all():
            new = first[~found]
            self._learn(distinct[~found], starts[new], ends[new], lowered)
            at, _ = self._place(distinct)
        at = at[which.ravel()]
        each = self.lengths[at]
        ids = self.ids[expanded(self.starts[at], each)] if len(at) else np.zeros(0, np.uint32)
        upto = np.concatenate([[0], np.cumsum(each)])
        return np.diff(upto[np.searchsorted(starts, bounds)]), ids

    def _encode_whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)
        parts = [np.array(e.ids, np.uint32) for e in found]
        return np.array([len(x) for x in parts], np.int64), np.concatenate([np.zeros(0, np.uint32), *parts])


def with_end(counts: np.ndarray, ids: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text."""
    stops = np.cumsum(counts + 1)
    out = np.full(int(stops[-1]) if len(stops) else 0, end_id, ids.dtype)
    own = np.ones(len(out), bool)
    own[stops - 1] = False
    out[own] = ids
    return counts + 1, out
