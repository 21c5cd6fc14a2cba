"""Token ids of whole texts by the tokenizers library, with a bounded memo of words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .shared import quiet_tokenizers

_MARK = b"|"
# First bytes of the combining marks that may join an ASCII letter.
_COMBINING = (b"\xcc", b"\xcd")
# Marks that no rule of the vocabulary joins with a letter before them.
_ENDINGS = b".,;:!?%#$&*"
_LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
# Runs of words in one call of the tokenizer, whose answer takes some 150 bytes an id.
_CALL = 16
# Words in a generation of the memo; two full ones take some 250 MB of a worker.
MEMO = 600_000


def _chunks(texts: Iterable[bytes], size: int) -> Iterator[list[bytes]]:
    """Runs of texts of about ``size`` bytes together; a longer text is a run of its own."""
    run: list[bytes] = []
    held = 0
    for text in texts:
        if run and held + len(text) > size:
            yield run
            run, held = [], 0
        run.append(text)
        held += len(text)
    if run:
        yield run


class WordEncoder:
    """Encodes texts with a vocabulary whose pre-tokenizer never joins two words.

    Such a vocabulary lower-cases, drops white space and splits at it, so the ids of a
    text are those of its words in turn. Only special tokens are matched before the
    lower-casing, so a text that has one in any case keeps its case here.

    Texts are taken in runs of about ``run`` bytes. Arrow splits a run and numbers its
    distinct words; these are looked up once each, and the ids of all words are then
    gathered by number. Each distinct word is encoded once while it is in the memo, many
    in one call, and the marks at the end of a word apart from it. The memo has two
    generations of about ``memo`` words each: when the young one is full it becomes the
    old one, and a word found in the old one moves back. All ids are the tokenizer's own.
    """

    def __init__(self, path: str, memo: int = MEMO, run: int = 1 << 21) -> None:
        quiet_tokenizers()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo, self.run = memo, run
        self.young: dict[bytes, bytes] = {b"": b""}
        self.old: dict[bytes, bytes] = {}
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content.encode().lower() for t in added if not t.normalized]
        self.mark = self.tokenizer.encode(_MARK.decode(), add_special_tokens=False).ids

    def whole(self, text: bytes) -> bytes:
        ids = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _encode(self, words: list[bytes]) -> None:
        plain = [w for w in words if _MARK not in w]
        self.young.update((w, self.whole(w)) for w in words if _MARK in w)
        runs = [plain[i : i + 256] for i in range(0, len(plain), 256)]
        for i in range(0, len(runs), _CALL):
            self._encode_runs(runs[i : i + _CALL])

    def _encode_runs(self, runs: list[list[bytes]]) -> None:
        joined = [(b" " + _MARK + b" ").join(run).decode() for run in runs]
        found = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        for run, encoding in zip(runs, found, strict=True):
            ids = np.array(encoding.ids, dtype="<u4")
            ends = np.append(np.flatnonzero(ids == self.mark[0]), len(ids)).tolist()
            if len(ends) != len(run) or len(self.mark) != 1:
                self.young.update((w, self.whole(w)) for w in run)
                continue
            raw, start = ids.tobytes(), 0
            for w, end in zip(run, ends, strict=True):
                self.young[w] = raw[4 * start : 4 * end]
                start = end + 1

    def _known(self, word: bytes) -> bytes | None:
        """The word's ids if the memo has them; they are then in the young generation."""
        ids = self.young.get(word)
        if ids is None and (ids := self.old.get(word)) is not None:
            self.young[word] = ids
        return ids

    def _learn(self, words: list[bytes]) -> None:
        """Puts the words into the young generation."""
        parts: dict[bytes, tuple[bytes, bytes]] = {}
        missing: dict[bytes, None] = {}
        for word in words:
            if self._known(word) is not None:
                continue
            stem = word.rstrip(_ENDINGS)
            if stem and len(stem) < len(word) and stem[-1] in _LETTERS:
                parts[word] = stem, word[len(stem) :]
                missing.update((x, None) for x in parts[word] if self._known(x) is None)
            else:
                missing[word] = None
        if missing:
            self._encode(list(missing))
        young = self.young
        for word, (stem, ending) in parts.items():
            young[word] = young[stem] + young[ending]

    def _cased(self, raw: bytes) -> bytes:
        """The text in lower case, or as it stands where that could change its ids."""
        for c in _COMBINING:
            if c in raw:
                return raw
        low = raw.lower()
        for s in self.special:
            if s in low:
                return raw
        return low

    def _run(self, texts: list[bytes]) -> list[bytes]:
        words = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        coded = words.values.dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()).to_pylist()
        if len(self.young) > self.memo:
            self.old, self.young = self.young, {b"": b""}
        ids = list(map(self.young.get, distinct))
        if None in ids:
            self._learn([w for w, x in zip(distinct, ids, strict=True) if x is None])
            ids = list(map(self.young.__getitem__, distinct))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(sizes) - sizes
        held = np.frombuffer(b"".join(ids), dtype="<u4")
        number = coded.indices.to_numpy()
        lengths = sizes[number]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if total + len(held) < 2**31 else np.int64
        places = np.repeat((starts[number] - ends + lengths).astype(kind), lengths)
        places += np.arange(total, dtype=kind)
        raw = held.take(places).tobytes()
        bounds = np.concatenate([[0], 4 * ends])[words.offsets.to_numpy()].tolist()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def encoded(self, texts: pa.Array) -> Iterator[bytes]:
        """``encode`` run by run: one run and its ids are in memory at a time.

        Arrow's pool keeps what a run has taken. It is given back at the end, as it counts
        like the memory of the executor's JVM.
        """
        raws = (self._cased(text.as_py()) for text in texts.cast(pa.binary()))
        for run in _chunks(raws, self.run):
            yield from self._run(run)
        pa.default_memory_pool().release_unused()

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        return list(self.encoded(texts))


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, memo: int = MEMO) -> WordEncoder:
    """This worker's encoder of a vocabulary; its memo serves all of the worker's tasks."""
    if (path, memo) not in _ENCODERS:
        _ENCODERS[path, memo] = WordEncoder(path, memo)
    return _ENCODERS[path, memo]
