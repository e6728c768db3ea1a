"""Token ids through the tokenizers library, word by word.

The two vocabularies cut a text before they merge symbols, and never across these places, so a
text's ids are the ids of its pieces one after the other:

``byte``  a single blank between two characters that are not white space starts a new piece
          (the blank belongs to what follows);
``word``  white space only separates.

The pieces of Latin letters, digits and signs are cut further, where letters meet digits or signs: both
vocabularies cut there too. A worker encodes each different part once with the library and then
looks it up. Tests compare the result with encoding whole texts.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Parts of texts a worker remembers. Beyond it those used once since the last time are dropped, which
# costs time and changes no result.
REMEMBERED = 400_000
# Unknown parts that are encoded in one call.
_AT_ONCE = 200

# White space beside a blank makes the cut after it unsafe.
_SAFE = re.compile(r"(?<=\S) (?=\S)")
_RARE_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

# Pieces that are cut into runs of letters, digits or signs: no quote (of "'s"), no "<" (of special tokens),
# no other letters than these, which are normal and have a lower case of their own.
_PLAIN = "[!-&(-;=-~À-ÖØ-öø-ÿ]+"
_LATIN = {"byte": f"^ ?{_PLAIN}(\n{_PLAIN})*$", "word": f"^{_PLAIN}$"}
# What a byte of such a piece is: 1 letter, 2 digit, 3 sign, 4 line end, 0 blank.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASS[48:58], _CLASS[10], _CLASS[32] = 2, 4, 0
# Lower case: A-Z, and the second bytes of À to Þ.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[[*range(65, 91), *range(128, 159)]] += 32
# How byte-level vocabularies write bytes; what stands between runs becomes a blank.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_WRITTEN = np.arange(256, dtype="<u2")
_WRITTEN[[k for k in range(256) if k not in _PRINTED]] = 256 + np.arange(256 - len(_PRINTED))
_BETWEEN = "\x1f"
_WRITTEN[ord(_BETWEEN)] = ord(" ")


def byte_ready(text: str) -> str | None:
    """The text, if each of its blanks starts a new piece of the byte-level vocabulary."""
    unsafe = "  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " " or _RARE_SPACE.search(text)
    return None if unsafe else text


def word_ready(text: str) -> str:
    """The text with a blank wherever the vocabulary that drops white space may cut."""
    return text.replace("\n", " ")


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of ranges, one range after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


class _Pieces(dict):
    """Numbers of parts in order of first sight; new ones wait in ``fresh``."""

    def __init__(self, pieces=()) -> None:
        super().__init__(zip(pieces, range(len(pieces))))
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.fresh.append(piece)
        return number


class Encoder:
    """Ids of whole texts, each followed by ``end``."""

    def __init__(self, path: str, kind: str, end: int, remembered: int = REMEMBERED) -> None:
        # A task has one core; the library's own threads would take others and spin between calls.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The same symbols and merges, for runs that are normal, cut and written as bytes already.
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        self.ready: Callable[[str], str | None] = byte_ready if kind == "byte" else word_ready
        # A byte-level piece has the blank before it.
        self.lead = " " if kind == "byte" else ""
        self.kind = kind
        # Cuts the text around it and has one id.
        self.separator = "<|endoftext|>" if kind == "byte" else " \x01 "
        self.separator_id = self._ids([self.separator])[0][0]
        # Whether an id holds a leading blank, and how many written bytes it stands for.
        vocabulary = self.tokenizer.get_vocab()
        self.blank, self.letters = np.zeros(max(vocabulary.values()) + 1, bool), np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, n in vocabulary.items():
            self.blank[n], self.letters[n] = token.startswith("Ġ"), len(token if kind == "byte" else token.removesuffix("</w>"))
        self.end, self.remembered = end, remembered
        self._forget()

    def _forget(self) -> None:
        # Number 0 is the end; a tuple, since any string may be a piece.
        self.known = _Pieces([("end",)])
        self.flat, self.starts, self.sizes = np.array([self.end], np.int32), np.zeros(1, np.int64), np.ones(1, np.int64)
        self.uses = np.full(1, 2, np.int64)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [one.ids for one in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _kind(self, piece: str) -> int:
        """How other pieces are encoded: joined, since their ids show where each begins (the only blank
        leads it); joined by the separator; alone, since it holds the separator."""
        if self.lead and piece.count(" ") == 1 and piece[0] == " " and len(piece) > 1 and not (piece[1].isspace() or piece[-1].isspace()):
            return 0
        return 1 if self.separator.strip() not in piece else 2

    def _of_runs(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of Latin runs, and how many each has."""
        written = _WRITTEN[np.frombuffer(_BETWEEN.join(runs).encode(), np.uint8)].tobytes().decode("utf-16-le").split(" ")
        groups = [" ".join(written[k : k + _AT_ONCE]) for k in range(0, len(written), _AT_ONCE)]
        calls = self.bare.encode_batch_fast(groups, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(one.ids for one in calls), np.int32)
        ends = np.cumsum(np.fromiter(map(len, written), np.int64, len(written)))
        return ids, np.diff(np.searchsorted(np.cumsum(self.letters[ids]), ends), prepend=-1)

    def _joined(self, pieces: list[str], between: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that are encoded many at once, and how many each has."""
        calls = self._ids([between.join(pieces[k : k + _AT_ONCE]) for k in range(0, len(pieces), _AT_ONCE)])
        if between:
            ids = np.fromiter(chain.from_iterable(chain((self.separator_id,), one) for one in calls), np.int32)
            places = np.flatnonzero(ids == self.separator_id)  # one before each piece
            return np.delete(ids, places), np.diff(np.append(places, len(ids))) - 1
        ids = np.fromiter(chain.from_iterable(calls), np.int32)
        return ids, np.diff(np.append(np.flatnonzero(self.blank[ids]), len(ids)))

    def _learn(self, runs: int) -> None:
        """Encode what is fresh: ``runs`` Latin runs, then other pieces."""
        fresh, self.known.fresh = self.known.fresh, []
        kinds = np.append(np.full(runs, 3), np.fromiter(map(self._kind, fresh[runs:]), np.int64, len(fresh) - runs))
        parts, end = [self.flat], len(self.flat)
        starts, sizes = np.zeros(len(fresh), np.int64), np.zeros(len(fresh), np.int64)
        for kind in range(4):
            chosen = np.flatnonzero(kinds == kind)
            if not len(chosen):
                continue
            these = [fresh[k] for k in chosen.tolist()]
            if kind < 2:
                ids, lengths = self._joined(these, self.separator if kind else "")
            elif kind == 2:
                found = self._ids(these)
                ids, lengths = np.fromiter(chain.from_iterable(found), np.int32), np.fromiter(map(len, found), np.int64)
            else:
                ids, lengths = self._of_runs(these)
            sizes[chosen], starts[chosen] = lengths, end + np.cumsum(lengths) - lengths
            parts.append(ids)
            end += len(ids)
        self.flat = np.concatenate(parts)
        self.starts = np.concatenate([self.starts, starts])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.uses = np.concatenate([self.uses, np.zeros(len(sizes), np.int64)])

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of numbered parts in a row, and where each part's ids end."""
        sizes = self.sizes[numbers]
        return self.flat[_spread(self.starts[numbers], sizes)], np.cumsum(sizes)

    def _trim(self) -> None:
        kept = np.flatnonzero(self.uses > 1)
        if 2 * len(kept) > self.remembered:
            return self._forget()
        self.flat, ends = self._gather(kept)
        self.sizes = self.sizes[kept]
        self.starts, self.uses = ends - self.sizes, np.zeros(len(kept), np.int64)
        self.uses[0] = 2
        pieces = list(self.known)
        self.known = _Pieces([pieces[k] for k in kept.tolist()])

    def _cut(self, texts: list[str | None]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Different pieces of texts, the pieces of all texts by their place among them, and how many
        pieces each text has. Arrow cuts at the blanks; texts with unsafe ones are cut one by one."""
        ready = [self.ready(text) if text else None for text in texts]
        easy = np.fromiter((one is not None for one in ready), bool, len(texts))
        odd = [k for k, text in enumerate(texts) if text and not easy[k]]
        # A first piece has no blank before it.
        split = [one.partition(" ") for one in ready if one is not None]
        heads = [head for head, _, _ in split]
        tails = pc.split_pattern(pa.array([tail if blank else None for _, blank, tail in split], pa.large_string()), " ")
        pieces = tails.flatten().dictionary_encode()
        cut = [_SAFE.split(texts[k]) for k in odd]
        rest = [one if not k else self.lead + one for whole in cut for k, one in enumerate(whole)]
        different = pc.binary_join_element_wise(pa.scalar(self.lead, pa.large_string()), pieces.dictionary, pa.scalar("", pa.large_string()))
        different = pa.concat_arrays([different, pa.array(heads, pa.large_string()), pa.array(rest, pa.large_string())])

        counts = np.zeros(len(texts), np.int64)
        counts[easy] = 1 + pc.fill_null(pc.list_value_length(tails), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        counts[odd] = np.fromiter(map(len, cut), np.int64, len(cut))
        found, first = np.zeros(int(counts.sum()), np.int64), np.zeros(int(counts.sum()), bool)
        first[(np.cumsum(counts) - counts)[easy]] = True
        of_easy = np.repeat(easy, counts)
        known = len(pieces.dictionary)
        found[first] = known + np.arange(len(heads))
        found[of_easy & ~first] = pieces.indices.to_numpy()
        found[~of_easy] = known + len(heads) + np.arange(len(rest))
        return different, found, counts

    def _runs(self, latin: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Runs of Latin pieces in a row, and how many each piece has."""
        offsets = np.frombuffer(latin.buffers()[1], np.int64)[latin.offset : latin.offset + len(latin) + 1]
        data = np.frombuffer(latin.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        if not self.lead:
            data = _LOWER[data]
        classes = _CLASS[data]
        blanks = np.flatnonzero(classes == 0)
        classes[blanks] = classes[blanks + 1]
        begins = np.ones(len(data), bool)
        begins[1:] = classes[1:] != classes[:-1]
        if not self.lead:
            begins |= classes == 2  # each digit by itself
        begins[offsets[:-1]] = True
        counts = np.add.reduceat(begins, offsets[:-1], dtype=np.int64)
        bounds = np.append(np.flatnonzero(begins), len(data)).astype(np.int64)
        return pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]), counts

    def _look_up(self, parts: pa.Array) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, parts.to_numpy(zero_copy_only=False)), np.int64, len(parts))

    def _parts(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the parts of pieces in a row, and how many each piece has; unknown ones are learned."""
        latin = pc.match_substring_regex(pieces, _LATIN[self.kind])
        others = pieces.filter(pc.invert(latin))
        latin = latin.to_numpy(zero_copy_only=False)
        counts, numbers, fresh = np.ones(len(pieces), np.int64), np.zeros(0, np.int64), 0
        if latin.any():
            runs, counts[latin] = self._runs(pieces.filter(pa.array(latin)))
            runs = runs.dictionary_encode()
            numbers = self._look_up(runs.dictionary)[runs.indices.to_numpy()]
            fresh = len(self.known.fresh)
        found = np.zeros(int(counts.sum()), np.int64)
        of_runs = np.repeat(latin, counts)
        found[of_runs], found[~of_runs] = numbers, self._look_up(others)
        if self.known.fresh:
            self._learn(fresh)
        return found, counts

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and where each text's ids begin (one more than texts)."""
        if len(self.known) > self.remembered:
            self._trim()
        pieces, places, pieces_of = self._cut(texts)
        parts, parts_of = self._parts(pieces)
        sizes = parts_of[places]
        # The end, number 0, after each text's parts.
        lasts = np.append(0, np.cumsum(sizes))[np.cumsum(pieces_of)] + np.arange(len(texts))
        found, inner = np.zeros(int(sizes.sum()) + len(texts), np.int64), np.ones(int(sizes.sum()) + len(texts), bool)
        inner[lasts] = False
        found[inner] = parts[_spread((np.cumsum(parts_of) - parts_of)[places], sizes)]
        self.uses += np.bincount(found, minlength=len(self.uses))
        ids, ends = self._gather(found)
        return ids, np.concatenate([[0], ends[lasts]]) if len(texts) else np.zeros(1, np.int64)


_encoders: dict[tuple[str, str, int, int], Encoder] = {}


def encoder(path: str, kind: str, end: int, remembered: int = REMEMBERED) -> Encoder:
    """The worker's encoder for a vocabulary; kept between tasks."""
    key = (path, kind, end, remembered)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def batches_of(texts: list[str | None], size: int = 1_000_000):
    """Ranges of texts of about ``size`` characters, so that one long text does not swell others."""
    start, held = 0, 0
    for at, text in enumerate(texts):
        held += len(text or "")
        if held >= size:
            yield start, at + 1
            start, held = at + 1, 0
    if start < len(texts):
        yield start, len(texts)
