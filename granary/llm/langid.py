"""Language identification of code-switched text: a linear-chain conditional random field over words."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import WordCache, bounded_batches, claim, fold_held_out, letting_go, steps
from granary.llm.labelled import sampled

WORD = re.compile(r"[^\W\d_]+")
BITS = 15
DIM = 1 << BITS
LEXICON = 2000
#: Documents that the fit learns from, each with its whole text.
MAX_DOCS = 600
ROW = 64
UNKNOWN = "und"


def words_of(text: str | None) -> list[str]:
    return [w for w in WORD.findall(text.lower())] if text else []


def has_letter(word: str) -> bool:
    return any(c.isalpha() for c in word)


def gram_slots(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each word's features, flat, and how many each has.

    n-grams of 1 to 4 characters over the word between border marks (those that
    touch a mark are its affixes), the whole word, and its place in the lexicon.
    """
    framed = [f"\x02{w}\x03" for w in words]
    codes = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.array([len(w) for w in framed], np.int64)
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(words)), lengths)
    slots, owners = [], []
    h = np.zeros(len(codes), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, 5):
            m = len(codes) - n + 1
            if m <= 0:
                break
            h = h[:m] * np.uint64(0x100000001B3) + (codes[n - 1 : n - 1 + m] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            inside = ends[owner[:m]] - np.arange(m) >= n
            mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            slots.append(((mixed >> np.uint64(64 - BITS)).astype(np.int64) % (DIM - LEXICON - 1))[inside])
            owners.append(owner[:m][inside])
    slots.append(np.array([DIM - 1 - lexicon.get(w, LEXICON) for w in words], np.int64))
    owners.append(np.arange(len(words)))
    slot, own = np.concatenate(slots), np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    return slot[order], np.bincount(own, minlength=len(words))


class ChainField:
    """Word labels y with p(y) ~ exp(sum emission(word, y) + sum transition(y, y'))."""

    def __init__(self, languages: list[str], lexicon: dict[str, int]):
        k = len(languages)
        self.languages, self.lexicon = languages, lexicon
        self.weights = np.zeros((DIM, k), np.float32)
        self.transition, self.start = np.zeros((k, k)), np.zeros(k)
        self._cache: WordCache | None = None

    def __getstate__(self):
        return self.__dict__ | {"_cache": None}

    def emissions(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Emission scores by distinct word, with a last column that says whether it has a letter."""
        if not words:
            return np.zeros(0, np.float32), np.zeros(0, np.int64)
        slots, lengths = gram_slots(words, self.lexicon)
        sums = np.add.reduceat(self.weights[slots], np.cumsum(lengths) - lengths, axis=0) / np.sqrt(lengths)[:, None]
        letters = np.array([has_letter(w) for w in words], np.float32)
        return np.concatenate([sums, letters[:, None]], axis=1).astype(np.float32).ravel(), np.full(len(words), len(self.languages) + 1)

    def cache(self) -> WordCache:
        if self._cache is None:
            self._cache = WordCache(self.emissions, np.float32, 120_000)
        return self._cache

    def marginals(self, emission: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Posterior of each word's label, for texts of ``counts`` words laid one after another."""
        return self._expect(emission, counts, False)[0]

    def _expect(self, emission: np.ndarray, counts: np.ndarray, want_moves: bool) -> tuple[np.ndarray, np.ndarray]:
        """Posteriors of the labels and, if wanted, the expected number of moves from label to label over all texts.

        Forward-backward in two levels: texts are cut into rows of ROW words,
        the transfer matrix of each row is made for all rows in step, rows are
        chained per text, and then all rows run forward and back in step. The
        steps don't grow with the length of a text.
        """
        k, n_words = emission.shape[1], len(emission)
        rows_of = -(-counts // ROW)
        n_rows, first = int(rows_of.sum()), np.cumsum(rows_of) - rows_of
        text_of = np.repeat(np.arange(len(counts)), rows_of)
        row_in_text = np.arange(n_rows) - first[text_of]
        opens = row_in_text == 0  # rows whose first word has no move before it
        begin = (np.cumsum(counts) - counts)[text_of] + row_in_text * ROW
        length = np.minimum(ROW, counts[text_of] - row_in_text * ROW)
        potential = np.exp(emission - emission.max(axis=1, keepdims=True))
        step = np.exp(self.transition - self.transition.max())
        head = np.exp(self.start - self.start.max())
        index = np.minimum(begin[:, None] + np.arange(ROW), n_words - 1)
        local = potential[index]  # (rows, ROW, k)
        live = np.arange(ROW) < length[:, None]
        transfer = np.broadcast_to(np.eye(k), (n_rows, k, k)).copy()
        for t in range(ROW):
            moved = transfer @ step
            if t == 0:
                moved[opens] = np.eye(k)
            moved *= local[:, t, None, :]
            moved /= np.maximum(moved.sum(axis=(1, 2), keepdims=True), 1e-300)
            transfer = np.where(live[:, t, None, None], moved, transfer)
        # Border vectors: alpha before each row (of a text's first the start potentials), beta after each row.
        alpha, beta = np.zeros((n_rows, k)), np.ones((n_rows, k))
        most = int(rows_of.max()) if len(rows_of) else 0
        for r in range(most):
            now = first[rows_of > r] + r
            if r == 0:
                alpha[now] = head
            else:
                a = np.einsum("nk,nkj->nj", alpha[now - 1], transfer[now - 1])
                alpha[now] = a / np.maximum(a.sum(axis=1, keepdims=True), 1e-300)
        for r in range(most - 2, -1, -1):
            now = first[rows_of > r + 1] + r
            b = np.einsum("nkj,nj->nk", transfer[now + 1], beta[now + 1])
            beta[now] = b / np.maximum(b.sum(axis=1, keepdims=True), 1e-300)
        forward = np.zeros((n_rows, ROW, k))
        a = alpha
        for t in range(ROW):
            before = a @ step
            if t == 0:
                before[opens] = head
            a = np.where(live[:, t, None], before * local[:, t], a)
            a = a / np.maximum(a.sum(axis=1, keepdims=True), 1e-300)
            forward[:, t] = a
        out, moves = np.zeros((n_words, k)), np.zeros((k, k))
        b = beta
        for t in range(ROW - 1, -1, -1):
            post = forward[:, t] * b
            post /= np.maximum(post.sum(axis=1, keepdims=True), 1e-300)
            own = live[:, t]
            out[(begin + t)[own]] = post[own]
            after = local[:, t] * b
            if want_moves:
                some = own if t else own & ~opens
                left, right = (forward[:, t - 1] if t else alpha)[some], after[some]
                total = np.einsum("nk,kj,nj->n", left, step, right)
                moves += step * np.einsum("nk,nj->kj", left / np.maximum(total, 1e-300)[:, None], right)
            nb = after @ step.T
            b = np.where(own[:, None], nb / np.maximum(nb.sum(axis=1, keepdims=True), 1e-300), b)
        return out, moves

    def gradient(self, emission: np.ndarray, counts: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the chains' log-likelihood, by emission score, transition and start: what is seen less what is expected."""
        k, starts = emission.shape[1], np.cumsum(counts) - counts
        follows = np.ones(len(gold), bool)
        follows[starts] = False
        later = np.flatnonzero(follows)
        post, moves = self._expect(emission, counts, True)
        by_word = -post
        by_word[np.arange(len(gold)), gold] += 1
        seen = np.bincount(gold[later - 1] * k + gold[later], minlength=k * k).reshape(k, k)
        return by_word, seen - moves, np.bincount(gold[starts], minlength=k) - post[starts].sum(axis=0)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Per text the language with the largest mean posterior over its words, and that mean."""
        k = len(self.languages)
        words: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            own = words_of(t)
            counts[i] = len(own)
            words += own
        flat, _ = self.cache().gather(self.cache().lookup(words))
        table = flat.reshape(-1, k + 1)
        lettered = table[:, k] > 0
        row = np.repeat(np.arange(len(texts)), counts)[lettered]
        table, counts = table[lettered, :k].astype(np.float64), np.bincount(row, minlength=len(texts))
        total = np.zeros((len(texts), k))
        some = np.flatnonzero(counts)
        if len(some):
            post = self.marginals(table, counts[some])
            total[some] = np.add.reduceat(post, np.cumsum(counts[some]) - counts[some], axis=0)
        mean = total / np.maximum(counts, 1)[:, None]
        best = mean.argmax(axis=1)
        names = [self.languages[b] if c else UNKNOWN for b, c in zip(best, counts, strict=True)]
        return names, np.where(counts > 0, np.clip(mean.max(axis=1), 0, 1), 0.0)

    def fit(self, examples: list[tuple[list[str], int]], rounds: int = 60, rate: float = 0.3, decay: float = 1e-4, seed: int = 5) -> ChainField:
        """Adam on the likelihood of whole label chains: spans of one language, and spans joined to code-switched ones."""
        k, rng = len(self.languages), np.random.default_rng(seed)
        order = rng.permutation(len(examples))
        chains = [(ws, [y] * len(ws)) for ws, y in examples]
        for a, b in zip(order[::2], order[1::2], strict=False):  # joined: half of one text, half of another
            (wa, ya), (wb, yb) = examples[a], examples[b]
            left, right = wa[: len(wa) // 2 + 1], wb[len(wb) // 2 :]
            chains.append((left + right, [ya] * len(left) + [yb] * len(right)))
        chains = [c for c in chains if c[0]]
        vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for ws, _ in chains for w in ws))}
        slots, lengths = gram_slots(list(vocabulary), self.lexicon)
        begins, scale = np.cumsum(lengths) - lengths, 1 / np.sqrt(lengths)
        ids = np.array([vocabulary[w] for ws, _ in chains for w in ws], np.int64)
        gold = np.array([y for _, ys in chains for y in ys], np.int64)
        counts = np.array([len(ws) for ws, _ in chains], np.int64)
        moments = [(np.zeros_like(x), np.zeros_like(x)) for x in (self.weights, self.transition, self.start)]
        weight = 1 / len(ids)
        for i in range(1, rounds + 1):
            per_word = np.add.reduceat(self.weights[slots], begins, axis=0) * scale[:, None]
            up, up_moves, up_start = self.gradient(per_word[ids].astype(np.float64), counts, gold)
            by_word = np.stack([np.bincount(ids, up[:, y], len(vocabulary)) for y in range(k)], axis=1)
            spread = np.repeat(by_word * scale[:, None], lengths, axis=0)
            up_weights = np.stack([np.bincount(slots, spread[:, y], DIM) for y in range(k)], axis=1)
            for value, up, (m, v) in zip((self.weights, self.transition, self.start), (up_weights, up_moves, up_start), moments, strict=True):
                down = decay * weight * value - up * weight
                m += 0.1 * (down - m)
                v += 0.01 * (down**2 - v)
                value -= (rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-9)).astype(value.dtype)
        return self


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = MAX_DOCS) -> ChainField:
    """Fit on the whole texts of at most ``most`` documents of the learning folds that have a language."""
    bounded_batches(docs.sparkSession)
    labelled = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang")).where("lang IS NOT NULL").dropDuplicates(["doc_id"])
    chosen = sampled(labelled, "doc_id", most)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("doc_id", "lang", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            chains = [[w for w in words_of(t) if has_letter(w)] for t in step.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([step.column(0), step.column(1), pa.array(chains, pa.list_(pa.string()))], names=["doc_id", "lang", "words"])

    rows = sorted((r for r in texts.mapInArrow(run, "doc_id long, lang string, words array<string>").collect() if r.words), key=lambda r: (r.doc_id, r.words))
    languages = sorted({r.lang for r in rows})
    seen: dict[str, Counter] = {y: Counter() for y in languages}
    for r in rows:
        seen[r.lang].update(set(r.words))
    lexicon: dict[str, int] = {}
    share = max(1, LEXICON // max(1, len(languages)))
    for y in languages:
        for w, _ in sorted(seen[y].items(), key=lambda x: (-x[1], x[0]))[:share]:
            if len(lexicon) < LEXICON:
                lexicon.setdefault(w, len(lexicon))
    field = ChainField(languages, lexicon)
    if len(languages) < 2:
        return field
    return field.fit([(r.words, languages.index(r.lang)) for r in rows])


def identify(docs: DataFrame, field: ChainField, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, from its whole text alone.

    Null texts and texts without a letter are 'und' with score 0, as is all
    when no language was learned. Repeated rows give repeated rows; a null id
    stays null and counts as not held out; empty tables give none; other
    columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        claim(model.cache())
        for step in steps(batches, "text", 2 << 20):
            texts = step.column(1).to_pylist()
            names, scores = model.predict(texts) if model.languages else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
            yield pa.RecordBatch.from_arrays([step.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", fold_held_out("doc_id").alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, field: ChainField, *, certain: float, text_col: str = "text") -> DataFrame:
    """The rows whose text has a language with a mean posterior of ``certain`` or more, judged in one pass without a join.

    Null and empty texts, those without a letter, and all texts where no
    language was learned, go. Whole texts are judged, whatever their length;
    equal rows are kept or go alike; all columns come back as they were,
    whatever their names; an empty table stays empty.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(field)
    place = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        claim(model.cache())
        for step in steps(batches, text_col, 2 << 20):
            if not model.languages:
                continue
            names, scores = model.predict(step.column(place).to_pylist())
            yield step.filter(pa.array([n != UNKNOWN and s >= certain for n, s in zip(names, scores.tolist(), strict=True)], pa.bool_()))

    return docs.mapInArrow(letting_go(run), docs.schema)
