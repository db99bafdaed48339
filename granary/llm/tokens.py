"""Token ids of whole texts, by a public tokenizer and a bounded cache of words."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from granary.llm.common import STORES, WordCache

#: Words that a worker keeps.
WORDS = 900_000
_HELD: dict[tuple, CachedTokenizer] = {}


#: Characters that may part new words in one call, as far as the vocabulary has an id of its own for one.
MARKERS = "\u2603\u2665\u266b\u2728\u2764"
JOINED = 1 << 12
#: Words that tell whether a vocabulary's model gives the ids of a word of letters by itself.
SAMPLES = ["a", "é", "straße", "größenordnungsmäßig", "ŝĝœ", "the", "it", "hello", "don", "re", "internationalisation", "zqxjkvw", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "schifffahrt", "s", "ll"]
#: Letters up to the second Latin extension: composed, so normal forms leave them.
LETTERS = re.compile("[a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: Byte-level vocabularies write a byte as the character of its number where that is printed, the others as those from 256 on.
SYMBOLS = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}
#: Before a line's first word, a text's, and a mark that was cut off the word before it.
MARKS = ("\n", "\r", "\0")
TAILS = ",."
#: Letters and digits that stay one such character when a vocabulary normalises and lower-cases them; a part of all is enough.
LETTER_END = r"[a-zA-Z0-9\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}\x{391}-\x{3A1}\x{3A3}-\x{3C9}\x{410}-\x{44F}\x{3041}-\x{3096}\x{30A1}-\x{30FA}\x{4E00}-\x{9FA5}\x{AC00}-\x{D7A3}]$"


class CachedTokenizer:
    """The ids that the tokenizer gives a whole text, computed word by word.

    A text whose white space is single spaces and line ends can be cut before
    each of them without changing its ids: neither kind of vocabulary joins
    across one. ``spaced`` vocabularies (byte-level) give a word's leading space
    to the word, and their texts with any other white space are encoded whole;
    others drop white space. Arrow cuts the texts and finds the distinct words,
    so Python looks at each once; new words are encoded many to a call. A text
    that holds an added token's characters, in any case, is encoded whole.
    """

    def __init__(self, path: str, spaced: bool, limit: int = WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.spaced = spaced
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = "(?i)" + "|".join(added) if added else ""
        self.cache = WordCache(self._compute, np.uint32, limit)
        self.odd: set[str] = set()
        vocabulary = self.tokenizer.get_vocab()
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for word, i in vocabulary.items():
            self.n_bytes[i] = len(word.removesuffix("</w>") if not spaced else word)  # one symbol a byte
        if not spaced:
            letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
            upper, lower = f"{letters} {' '.join(letters)}", f"{letters} {' '.join(letters)}".lower()
            self.folds = self._ids([upper])[0].tolist() == self._ids([lower])[0].tolist()  # A-Z count as a-z
            alone = {c: self._ids([c])[0] for c in MARKERS}
            self.marker, self.marker_id = next(((c, int(i[0])) for c, i in alone.items() if len(i) == 1), ("", -1))

        self.model, self.lead = self.tokenizer.model, "\u0120" if spaced else ""  # the byte-level sign of a space
        self.direct = self._same(SAMPLES)

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = list(map(len, ids))
        return np.fromiter((i for x in ids for i in x), np.uint32, sum(lengths)), lengths

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of words that follow each other in one text; None if they can't be told apart again."""
        plain = not self.spaced and all(map(str.isascii, words))
        if self.spaced or plain:
            ids, _ = self._ids([(" " if plain else "").join(words)])
            ends = np.cumsum(np.fromiter(map(len, words if plain else map(str.encode, words)), np.int64, len(words)))
            at = np.cumsum(self.n_bytes[ids])
            cut = np.searchsorted(at, ends)
            if len(ids) and (cut[-1] >= len(at) or (at[cut] != ends).any()):
                return None
            return ids, np.diff(np.concatenate([[0], cut + 1]))
        text = f" {self.marker} ".join(words)
        if not self.marker or text.count(self.marker) != len(words) - 1:
            return None
        ids, _ = self._ids([text])
        marks = np.flatnonzero(ids == self.marker_id)
        if len(marks) != len(words) - 1:
            return None
        lengths = np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1
        return np.delete(ids, marks), lengths

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters by the vocabulary's model alone: nothing that comes before it alters or cuts them."""
        flat: list[int] = []
        lengths = np.empty(len(words), np.int64)
        for k, w in enumerate(words):
            own = [t.id for t in self.model.tokenize(self.lead + (w if w.isascii() else w.encode().decode("latin-1").translate(SYMBOLS)))]
            flat += own
            lengths[k] = len(own)
        return np.array(flat, np.uint32), lengths

    def _compute(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids by word; words of letters go to the model, some of them the long way too, to see that it is the same."""
        if not self.direct:
            return self._compute_others(words)
        plain = np.fromiter((LETTERS.fullmatch(w) is not None and (self.spaced or w.islower()) for w in words), bool, len(words))
        letters = [w for w, p in zip(words, plain.tolist(), strict=True) if p]
        if not self._same(letters[:: max(1, len(letters) // 4)]):
            self.direct = False
            return self._compute_others(words)
        ids, sizes = self._compute_others([w for w, p in zip(words, plain.tolist(), strict=True) if not p])
        return _interleave(ids, sizes, *self._letters(letters), np.flatnonzero(plain))

    def _same(self, words: list[str]) -> bool:
        ids, sizes = self._letters(words)
        whole, whole_sizes = self._ids([" " * self.spaced + w for w in words])
        return sizes.tolist() == whole_sizes and ids.tolist() == whole.tolist()

    def _compute_others(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids by word; in ``spaced`` mode a word whose inner white space forbids cutting gets no ids and is noted."""
        flat, lengths = [], []
        i = 0
        while i < len(words):
            j, size = i, 0
            while j < len(words) and size < JOINED:
                size += len(words[j]) + 1
                j += 1
            some = words[i:j]
            if self.spaced:  # "\n" is part of the text, "\r" marks the first word of one
                plain = [w[1:] if w[:1] in MARKS else w for w in some]
                odd = [not w or len(w.split()) != 1 or w != w.strip() for w in plain]
                self.odd.update(w for w, o in zip(some, odd, strict=True) if o)
                own = [(k, "" if odd[k] else w[1:]) for k, w in enumerate(some) if odd[k] or w[0] in MARKS[1:]]
                texts = [w if w[0] == "\n" else " " + w for w, o in zip(some, odd, strict=True) if not o and w[0] not in MARKS[1:]]
                ids, sizes = self._each(texts)
                first_ids, first_sizes = self._ids([w for _, w in own])
                ids, sizes = _interleave(ids, sizes, first_ids, np.array(first_sizes, np.int64), np.array([k for k, _ in own], np.int64))
            else:
                own = [(k, w) for k, w in enumerate(some) if not w.isascii()]
                ids, sizes = self._each([w for w in some if w.isascii()])
                more, more_sizes = self._each([w for _, w in own])
                ids, sizes = _interleave(ids, sizes, more, more_sizes, np.array([k for k, _ in own], np.int64))
            flat.append(ids)
            lengths.append(sizes)
            i = j
        return np.concatenate([np.zeros(0, np.uint32), *flat]), np.concatenate([np.zeros(0, np.int64), *lengths])

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if texts and (got := self._joined(texts)) is not None:
            return got
        ids, sizes = self._ids(texts)
        return ids, np.array(sizes, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after another, and the number of ids of each; null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        some = np.flatnonzero(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        per_text = np.zeros(len(texts), np.int64)
        if not len(some):
            return np.zeros(0, np.uint32), per_text
        texts = texts.take(pa.array(some))
        cut = pc.binary_join_element_wise(pa.scalar("\r", pa.large_string()), texts, pa.scalar("", pa.large_string())) if self.spaced else texts
        if not self.spaced and self.folds:
            cut = pc.ascii_lower(cut)
        cut = pc.replace_substring(cut, "\n", " \n" if self.spaced else " ")
        for c in TAILS:
            cut = pc.replace_substring(cut, c + " ", f" \0{c} " if self.spaced else f" {c} ")
        lists = pc.split_pattern(cut, " ")
        encoded = lists.flatten().dictionary_encode()
        distinct, index = encoded.dictionary.to_numpy(zero_copy_only=False).tolist(), encoded.indices.to_numpy()
        if len(self.cache.number) > self.cache.limit:
            self.odd.clear()
        numbers = self.cache.lookup(distinct)[index]
        flat, lengths = self.cache.gather(numbers)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        ends = np.concatenate([[0], np.cumsum(lengths)])[offsets]
        sizes = np.diff(ends)
        strange = [i for i, w in enumerate(distinct) if w in self.odd] if self.odd else []
        if self.added:  # the library takes these out of a text before anything else
            strange += np.flatnonzero(pc.match_substring_regex(encoded.dictionary, self.added).to_numpy(zero_copy_only=False)).tolist()
        marked = np.zeros(len(texts), bool)
        for c in "\r\0" if self.spaced else "":
            marked |= pc.match_substring(texts, c).to_numpy(zero_copy_only=False)
        # A mark may be cut off only behind a letter or digit; elsewhere it belongs to a run of marks.
        tails = np.zeros(len(distinct), bool)
        for c in TAILS:
            tails |= pc.equal(encoded.dictionary, ("\0" if self.spaced else "") + c).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(tails[index])
        behind = pc.match_substring_regex(encoded.dictionary, LETTER_END).to_numpy(zero_copy_only=False)
        at = at[~behind[index[at - 1]] | (at == 0)]
        if strange or len(at) or marked.any():
            flagged = np.zeros(len(distinct), bool)
            flagged[strange] = True
            at = np.union1d(np.flatnonzero(flagged[index]), at)
            whole = np.union1d(np.searchsorted(offsets, at, side="right") - 1, np.flatnonzero(marked)).astype(np.int64)
            keep = np.ones(len(sizes), bool)
            keep[whole] = False
            flat, sizes = flat[np.repeat(keep, sizes)], np.where(keep, sizes, 0)
            more, more_sizes = self._ids(texts.take(pa.array(whole)).to_pylist())
            flat, sizes = _interleave_at(flat, sizes, more, np.array(more_sizes, np.int64), whole)
        per_text[some] = sizes
        return flat, per_text


def _interleave(ids: np.ndarray, sizes: np.ndarray, more: np.ndarray, more_sizes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two flat stores as one, where the second's entries get the stated places among all."""
    n = len(sizes) + len(more_sizes)
    lengths = np.zeros(n, np.int64)
    other = np.ones(n, bool)
    other[places] = False
    lengths[other] = sizes
    return _interleave_at(ids, lengths, more, more_sizes, places)


def _interleave_at(ids: np.ndarray, lengths: np.ndarray, more: np.ndarray, more_sizes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Put the entries of ``more`` at places whose length in ``lengths`` is 0."""
    if not len(places):
        return ids, lengths
    at = (np.cumsum(lengths) - lengths)[places]
    out = lengths.copy()
    out[places] = more_sizes
    return np.insert(ids, np.repeat(at, more_sizes), more), out


def tokenizer(path: str, spaced: bool, limit: int = WORDS) -> CachedTokenizer:
    """One per Python worker; its cache serves all tasks of the worker."""
    key = (path, spaced, limit)
    if key not in _HELD:
        _HELD[key] = CachedTokenizer(path, spaced, limit)
    return _HELD[key]


def _let_go(own: tuple[WordCache, ...]) -> bool:
    others = [key for key, t in _HELD.items() if all(t.cache is not c for c in own)]
    for key in others:
        del _HELD[key]
    return bool(others)


STORES.append(_let_go)


def public_vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))
