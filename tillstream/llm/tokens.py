"""Token ids of texts by a public tokenizer, chunk by chunk with a bounded cache.

The tokenizer drops white space and never joins across it, so the ids of a text are those of its
chunks between spaces, one after the other. Chunks repeat very often; each is encoded once by the
tokenizers library and then looked up. A run of letters and the punctuation behind it are encoded
apart too, so ``word``, ``word,`` and ``Word.`` cost one call.
"""

from __future__ import annotations

import os
import re
from itertools import chain, compress

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

from tillstream.llm import common

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

VOCABULARY = "word_bpe_49k.json"

#: Distinct chunks a worker keeps; beyond them, those used only once so far are forgotten.
CACHE_CHUNKS = 600_000

#: Unseen chunks encoded together; their offsets tell them apart.
JOINED_CHUNKS = 2_000

#: Letters that stay one letter each in lower case and in composed form, so that a chunk of them is one word.
_LETTERS = "a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_ONE_WORD = f"^[{_LETTERS}]+$"


def _byte_letters() -> list[str]:
    """The letter by which a byte-level vocabulary writes each byte: itself, or if it does not print, one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in prints else next(others)) for b in range(256)]


#: The letters in lower case as the vocabulary writes them.
_SPELLED = str.maketrans(
    {c: "".join(_byte_letters()[b] for b in c.lower().encode()) for c in map(chr, range(256)) if re.match(_ONE_WORD, c)}
)

#: Punctuation that the tokenizer cuts off behind a letter or a digit; the rest has the same ids without it. So has an
#: ASCII word in lower case.
_TAIL = ".,!?;:#$%&*|"


def path(vocabulary: str = VOCABULARY) -> str:
    return public_tokenizers.path(vocabulary)


def strings(texts: pa.Array) -> list[str]:
    """The texts of an array without nulls; quicker than ``to_pylist``, which makes a scalar of each."""
    return texts.to_numpy(zero_copy_only=False).tolist()


class _Kinds:
    """How the ids of unseen chunks are found: masks, which share no chunk."""

    def __init__(self, chunks: list[str]) -> None:
        texts = pa.array(chunks, pa.string())
        cores = pc.ascii_rtrim(texts, characters=_TAIL)
        tail, capital = pc.not_equal(cores, texts), pc.and_not(pc.ascii_is_alpha(texts), pc.ascii_is_lower(texts))
        self.cores, self.lower = strings(cores.filter(tail)), strings(pc.ascii_lower(texts.filter(capital)))
        self.tail, self.capital, word = (
            m.to_numpy(zero_copy_only=False) for m in (tail, capital, pc.match_substring_regex(texts, _ONE_WORD))
        )
        self.word = word & ~self.capital
        self.other = ~(self.tail | self.capital | self.word)


class _Chunks(dict):
    """Chunk to number; an unseen chunk gets the next number and waits to be encoded."""

    def __init__(self, known: list[str]) -> None:
        super().__init__((chunk, i) for i, chunk in enumerate(known))
        self.waiting: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self.waiting.append(chunk)
        self[chunk] = number = len(self)
        return number

    def numbers(self, distinct: list[str]) -> np.ndarray:
        found = np.array([self.get(chunk, -1) for chunk in distinct], np.int64)
        unseen = list(compress(distinct, (found < 0).tolist()))
        found[found < 0] = given = np.arange(len(self), len(self) + len(unseen))
        self.update(zip(unseen, given.tolist(), strict=True))
        self.waiting += unseen
        return found


class Encoder:
    """``encode(texts)`` gives all ids in a row and the number of ids of each text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.model = self.tokenizer.model
        probe = [f"{a}{c}{b}" for c in map(chr, _SPELLED) for a, b in (("", ""), ("a", "B"), ("\u00c9", "\u00e9"))]
        self.spells = all(
            self._spelled([w])[0].tolist() == self.tokenizer.encode(w, add_special_tokens=False).ids for w in probe
        )
        self.chunks = _Chunks([""])
        self.flat = np.zeros(0, np.uint32)
        self.begins, self.lengths, self.uses = (np.zeros(1, np.int64) for _ in range(3))

    def _gather(self, numbers: np.ndarray) -> np.ndarray:
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.begins[numbers] - ends + lengths, lengths)
        return self.flat[shift + np.arange(len(shift))]

    def _add(self, numbers: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.begins[numbers] = len(self.flat) + np.cumsum(lengths) - lengths
        self.lengths[numbers] = lengths
        self.flat = np.concatenate([self.flat, ids])

    def _spelled(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of ``_LETTERS`` in a row, and how many each has.

        Nothing is to be normalized or split in them, so they go to the model itself, without the rest of the library.
        """
        found = [[t.id for t in self.model.tokenize(w.translate(_SPELLED))] for w in words]
        return np.array(list(chain.from_iterable(found)), np.uint32), np.array(list(map(len, found)), np.int64)

    def _encoded(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of any chunks in a row, and how many each has."""
        one = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
        begins = np.cumsum([0, *[len(c) + 1 for c in some[:-1]]])
        of = np.searchsorted(begins, [begin for begin, _ in one.offsets], side="right") - 1
        return np.array(one.ids, np.uint32), np.bincount(of, minlength=len(some))

    def _learn(self) -> None:
        chunks, lowered, tailed = self.chunks, [], []
        words, others = ([], []), ([], [])  # numbers, chunks
        while chunks.waiting:  # parts may turn out to be unseen in turn
            waiting, chunks.waiting = chunks.waiting, []
            numbers = range(len(chunks) - len(waiting), len(chunks))
            kinds = _Kinds(waiting)
            capital, tail, word = kinds.capital.tolist(), kinds.tail.tolist(), kinds.word.tolist()
            for group, mask in ((words, word), (others, kinds.other.tolist())):
                group[0].extend(compress(numbers, mask))
                group[1].extend(compress(waiting, mask))
            lowered += [(n, chunks[c], 0) for n, c in zip(compress(numbers, capital), kinds.lower, strict=True)]
            for n, chunk, core in zip(compress(numbers, tail), compress(waiting, tail), kinds.cores, strict=True):
                if core and core[-1].isalnum():
                    tailed.append((n, chunks[core], chunks[chunk[len(core) :]]))
                else:
                    others[0].append(n)
                    others[1].append(chunk)
        grown = len(chunks) - len(self.lengths)
        self.begins, self.lengths, self.uses = (
            np.concatenate([a, np.zeros(grown, np.int64)]) for a in (self.begins, self.lengths, self.uses)
        )
        for (numbers, some), ids_of in ((words, self._spelled if self.spells else self._encoded), (others, self._encoded)):
            found = [ids_of(some[at : at + JOINED_CHUNKS]) for at in range(0, len(some), JOINED_CHUNKS)]
            if found:
                ids, counts = map(np.concatenate, zip(*found, strict=True))
                self._add(np.array(numbers, np.int64), counts, ids)
        # a part without its tail may in turn be a capital form, so those come first
        for some in (lowered, tailed):
            if some:
                pairs = np.array(some, np.int64)
                self._add(pairs[:, 0], self.lengths[pairs[:, 1:]].sum(axis=1), self._gather(pairs[:, 1:].ravel()))

    def _forget(self) -> None:
        """Keep the chunks used more than once."""
        kept = np.flatnonzero(self.uses > 1)
        kept = np.concatenate([[0], kept[kept > 0]])
        names = list(self.chunks)
        lengths, flat = self.lengths[kept], self._gather(kept)
        self.chunks = _Chunks([names[i] for i in kept.tolist()])
        self.flat, self.lengths = flat, lengths
        self.begins, self.uses = np.cumsum(lengths) - lengths, np.zeros(len(kept), np.int64)

    def encode(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.chunks) > CACHE_CHUNKS:
            self._forget()
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        chunks, counts = common.chunks_of(texts.fill_null(""))
        known = self.chunks.numbers(strings(chunks.dictionary))
        if self.chunks.waiting:
            self._learn()
        of = known[chunks.indices.to_numpy()]
        self.uses += np.bincount(of, minlength=len(self.uses))
        total = np.concatenate(([0], np.cumsum(self.lengths[of])))
        return self._gather(of), np.diff(total[np.concatenate(([0], np.cumsum(counts)))])


def encoder(path: str) -> Encoder:
    """One encoder for each worker process, kept between its tasks until the worker does other work."""
    return common.kept(("encoder", path), lambda: Encoder(path))


def with_end(ids: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """``end`` put after the ids of each text."""
    return np.insert(ids, np.cumsum(lengths), end).astype(np.uint32), lengths + 1
