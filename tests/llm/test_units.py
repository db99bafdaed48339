"""Small parts against plain definitions."""

import itertools
import random
import sys
import types
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from granary.llm import decontaminate, embed, langid, pack, quality, simhash, substring, suffix, token_count, tokenfile
from granary.llm.common import union_min
from granary.llm.tokens import CachedTokenizer, public_vocabulary


def test_union_min():
    r = random.Random(1)
    for _ in range(50):
        n = r.randint(1, 30)
        links = [(r.randrange(n), r.randrange(n)) for _ in range(r.randint(0, 30))]
        want = list(range(n))
        for _ in range(n):
            for a, b in links:
                want[a] = want[b] = min(want[a], want[b])
        got = union_min(n, np.array([a for a, _ in links], int), np.array([b for _, b in links], int))
        assert got.tolist() == want


def test_steps_put_small_batches_together():
    from granary.llm.common import steps

    r = random.Random(8)
    sizes = [r.choice([0, 3, 10, 50, 200, None]) for _ in range(400)]
    table = pa.table({"i": range(400), "text": pa.array([None if n is None else "x" * n for n in sizes], pa.string())})
    got = list(steps(table.to_batches(max_chunksize=7), "text", 100))
    assert [i for b in got for i in b.column(0).to_pylist()] == list(range(400))
    bytes_of = [sum(len(t or "") for t in b.column(1).to_pylist()) for b in got]
    assert all(n <= 100 or b.num_rows == 1 for n, b in zip(bytes_of, got, strict=True))
    assert len(got) < 200


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_cached_tokenizer_equals_whole_texts(name, spaced):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_vocabulary(name))
    r = random.Random(3)
    parts = ["a", "B", "é", "ß", " ", "  ", "\n", "\n\n", "\t", "\r\n", " ", "\x1c", ".", "!!", "'s", "12", "♥", "İ", "Σ", "é", "<|endoftext|>", "a <|endoftext|> b", "<|startoftext|>", "<|ENDOFTEXT|>", "日本", "\x00", " don't", " schön", " é", " straße", " ŝŒĝ", " ﬁ", " ª", " ǅ", " œuvre", ", ", ". ", "., ", ", , ", "x, ", "é. ", ".\n"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 30))) for _ in range(1500)] + [None, "", " ", "\n"]
    cached = CachedTokenizer(public_vocabulary(name), spaced, limit=300)
    for i in range(0, len(texts), 400):
        some = texts[i : i + 400]
        ids, lengths = cached.encode(pa.array(some, pa.string()))
        ends = np.cumsum(lengths)
        for text, n, e in zip(some, lengths, ends, strict=True):
            assert ids[e - n : e].tolist() == whole.encode(text or "", add_special_tokens=False).ids, text


@given(st.lists(st.integers(0, 60), max_size=3000), st.integers(61, 4000))
@settings(max_examples=40, deadline=None)
def test_blocks_round_trip(ids, alphabet):
    block = tokenfile.encode_block(np.array(ids, np.int32), alphabet)
    assert tokenfile.decode_block(block).tolist() == ids


def test_damaged_block_is_told():
    block = bytearray(tokenfile.encode_block(np.arange(5000, dtype=np.int32) % 97, 97))
    block[60] ^= 1
    with pytest.raises(tokenfile.CorruptBlock):
        tokenfile.decode_block(bytes(block))


def test_model_predicts():
    ids = np.tile(np.random.default_rng(1).integers(0, 40_000, 50), 4000).astype(np.int32)
    assert len(tokenfile.encode_block(ids, 49_408)) * 8 / len(ids) < 4  # 15.6 bits an id without a model


def test_model_gains_on_text():
    """Ids of real texts take well under their order-0 entropy, in blocks of the size that files have."""
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"])["text"].combine_chunks()[:2500]
    ids = CachedTokenizer(public_vocabulary("word_bpe_49k.json"), False).encode(texts)[0][: tokenfile.BLOCK_IDS].astype(np.int32)
    share = np.bincount(ids) / len(ids)
    entropy = -float((share[share > 0] * np.log2(share[share > 0])).sum())
    block = tokenfile.encode_block(ids, 49_408)
    assert len(ids) == tokenfile.BLOCK_IDS and len(block) * 8 / len(ids) < 6.8 < entropy - 1.4
    assert np.array_equal(tokenfile.decode_block(block), ids)


@pytest.mark.parametrize("ids", [[0] * 5000, list(range(5000)), [7], [524_287, 0] * 700, [3, 1, 4, 1, 5] * 300])
def test_odd_blocks(ids):
    alphabet = max(ids) + 1
    assert tokenfile.decode_block(tokenfile.encode_block(np.array(ids, np.int32), alphabet)).tolist() == ids


def test_joined_checksum():
    assert tokenfile.crc32_join(zlib.crc32(b"ab"), zlib.crc32(b"cdefg"), 5) == zlib.crc32(b"abcdefg")


def test_piece_counts_equal_greedy_matching():
    pieces = {b"a", b"ab", b"abcd", b"bc", b"bcd", b"cde", b"de", b" a", b" ab", b" abx", b"x"}
    counter = token_count.PieceCounter(pieces)
    known, r = pieces | {bytes([b]) for b in range(256)}, random.Random(2)

    def greedy(s):
        n = 0
        while s:
            k = next(k for k in range(len(s), 0, -1) if s[:k] in known)
            s, n = s[k:], n + 1
        return n

    for _ in range(3000):
        word = bytes(r.choices(b"abcdex", k=r.randint(1, 20)))
        assert counter.count(word) == greedy(b" " + word), word


def test_fingerprint_by_definition():
    def plain(text):
        words = text.lower().split()
        grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0

    for text in [b"", b"  ", b"one", b"One two", b"a b c", b"a b c a b c a", "É b c\x0bd".encode(), b" ".join(b"w%d" % (i % 50) for i in range(70_000))]:
        assert simhash.fingerprint(text) == plain(text)


def test_link_shard_by_all_pairs():
    r = np.random.default_rng(5)
    centres = r.integers(0, 2**63, 40).astype(np.uint64)
    points = np.unique(np.concatenate([centres[r.integers(0, 40, 900)] ^ (np.uint64(1) << r.integers(0, 64, 900).astype(np.uint64)), centres]))
    d = np.bitwise_count(points[:, None] ^ points[None, :])
    want = union_min(len(points), *np.nonzero(d <= 2))
    every = np.ones(len(points), bool)
    assert simhash.link_shard(points, every, every, 2).tolist() == want.tolist()
    tree = simhash.VantageTree(points[::3], 8)
    links = []
    homes = np.zeros(len(points), int)
    for _, which, home in tree.route(points, 2):
        homes[which[home]] += 1
        root = simhash.link_shard(points[which], home, np.ones(len(which), bool), 2)
        links += [(which[i], which[j]) for i, j in enumerate(root)]
    assert (homes == 1).all()
    assert union_min(len(points), *np.array(links).T).tolist() == want.tolist()


def test_groups_of_strings_are_sorted_by_themselves():
    r = random.Random(14)
    for _ in range(40):
        strings = [bytes(r.choices(b"ab", k=r.randint(0, 70))) + r.choice([b"", b"tail" * 20]) for _ in range(r.randint(1, 80))]
        group = np.sort(np.array([r.randrange(5) for _ in strings]))
        sizes = np.array([len(s) for s in strings])
        grid = suffix.strings_of(np.frombuffer(b"".join(strings) + b"\0", np.uint8), np.cumsum(sizes) - sizes, sizes)
        number = suffix.same_strings(grid, sizes, group, 16)
        name = [(g, s) for g, s in zip(group.tolist(), strings, strict=True)]
        assert len(set(number.tolist())) == len(set(name)) == len(set(zip(number.tolist(), name, strict=True)))


def removed_by_sorting(texts, hot):
    """The parts of op10 between the shuffles, on one step: document and range of all that goes."""
    import types

    from granary.llm.repeats import undeal

    text, place, h, _, _ = suffix.anchors(texts)
    keys, times = np.unique(h, return_counts=True)
    twice = np.isin(h, keys[times > 1])
    blobs = [(place[(text == k) & twice] * 2).astype("<u4").tobytes() for k in range(len(texts))]
    step = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array([0] * len(texts), pa.int32()), pa.array(texts, pa.binary()), pa.array(blobs, pa.binary())], names=["doc", "tie", "text", "places"])
    known = types.SimpleNamespace(value=keys if hot else keys[:0])
    found = undeal(suffix._judge(100, 1)(list(suffix._contexts(100, known, 1)([step]))))
    return sorted(zip(*(found[n].to_pylist() for n in ("doc", "start", "end")), strict=True)) if found is not None else []


@pytest.mark.parametrize("hot", [False, True])
def test_every_removal_comes_from_the_sort(monkeypatch, hot):
    r = random.Random(6)
    shared = [bytes(r.choices(b"abcdef ", k=n)) for n in (120, 260, 90)]
    texts = [bytes(r.choices(b"ghij", k=r.randint(0, 90))) + r.choice(shared) + r.choice(shared) + bytes(r.choices(b"klmn", k=r.randint(0, 90))) for _ in range(40)] + [b"zz" * 200]
    seen, want = set(), []
    for d, t in enumerate(texts):
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - 99):
            if t[s : s + 100] in seen:
                gone[s : s + 100] = True
            seen.add(t[s : s + 100])
        want.append(gone)
    got = [np.zeros(len(t), bool) for t in texts]
    for d, a, b in removed_by_sorting(texts, hot):
        got[d][a:b] = True
    assert all(np.array_equal(a, b) for a, b in zip(got, want, strict=True)) and sum(w.sum() for w in want) > 5000
    real = suffix.sort_suffixes
    monkeypatch.setattr(suffix, "sort_suffixes", lambda *args: (real(*args)[0], np.zeros(len(args[1]), np.int64)))
    assert removed_by_sorting(texts, hot) == []


def test_deep_shallow_order():
    r = random.Random(4)
    for _ in range(120):
        base = [bytes(r.choices(b"ab\0", k=r.randint(0, 110))) for _ in range(4)]
        strings = [(r.choice(base)[: r.randint(0, 110)] + bytes(r.choices(b"ab\0", k=r.randint(0, 3)))) for _ in range(r.randint(1, 60))]
        for shallow in (8, 64):
            order, lcp = suffix.deep_shallow(strings, shallow)
            got = [strings[i] for i in order]
            assert got == sorted(strings)
            assert lcp[1:].tolist() == [suffix.common_prefix(a, b) for a, b in zip(got, got[1:], strict=False)]


@pytest.mark.parametrize("kind, least", [(substring.LINE, 0.99), (substring.SENTENCE, 0.98)])
def test_bands_meet_pairs_at_the_threshold(kind, least):
    """Paragraphs of 49 words that differ in the middle one have a shingle similarity of exactly 40 / 50."""
    n, met = 1000, 0
    for i in range(n):
        words = [f"w{i}x{k}" for k in range(49)]
        other = [*words[:24], f"v{i}", *words[25:]]
        ending = f". End{i} of this line here now." if kind == substring.SENTENCE else ""
        keys = []
        for text in (words, other):
            p = substring.Paragraphs([(" ".join(text) + ending).encode()])
            at = np.flatnonzero(p.kind == kind)[0]
            keys.append(set(p.keys[at].tolist()))
        met += bool(keys[0] & keys[1])
    assert met >= least * n


def test_link_sets_by_all_pairs():
    r = random.Random(6)
    for _ in range(60):
        base = [r.sample(range(500), 30) for _ in range(3)]
        sets = []
        for _ in range(r.randint(2, 25)):
            s = set(r.choice(base))
            for _ in range(r.randint(0, 5)):
                s.discard(r.choice(sorted(s)))
                s.add(r.randrange(500, 900))
            sets.append(np.array(sorted(s), np.uint32))
        a, b = np.array([(i, j) for i in range(len(sets)) for j in range(i) if (x := len(np.intersect1d(sets[i], sets[j]))) >= 0.8 * (len(sets[i]) + len(sets[j]) - x)] or np.zeros((0, 2), int)).T
        links = np.array(substring.link_sets(sets, 0.8) or np.zeros((0, 2), int)).T
        assert union_min(len(sets), *links.astype(int)).tolist() == union_min(len(sets), a.astype(int), b.astype(int)).tolist()


def test_link_sets_joined_by_one_pair():
    """Two stars of 65 sets that only a leaf of each joins, looked at in the order of the list as all sizes are equal."""
    fresh = iter(range(1000, 100_000))

    def edited(s, at, n):
        return [*s[:at], *[next(fresh) for _ in range(n)], *s[at + n :]]

    a0 = list(range(40))
    a1 = edited(a0, 0, 4)
    b1 = edited(a1, 4, 4)
    b0 = edited(b1, 8, 4)
    leaves = [edited(c, 12 + k % 25, 3) for c in (a0, b0) for k in range(63)]
    sets = [np.array(sorted(s), np.uint32) for s in (a0, a1, b0, b1, *leaves)]
    links = np.array(substring.link_sets(sets, 0.8)).T
    assert set(union_min(len(sets), *links).tolist()) == {0}


def test_link_sets_of_long_chains():
    """One chain of edited copies, each near only a few others, in buckets of hundreds of sets."""
    r = random.Random(11)
    for _ in range(20):
        own, sets = list(range(40)), []
        for k in range(r.randint(200, 400)):
            sets.append(np.array(sorted(own), np.uint32))
            for at in r.sample(range(40), r.randint(1, 5)):
                own[at] = 100 + k * 50 + at
        r.shuffle(sets)
        held = np.zeros((len(sets), 100 + 400 * 50), np.float32)
        for i, s in enumerate(sets):
            held[i, s] = 1
        both = held @ held.T
        want = union_min(len(sets), *np.nonzero(both >= 0.8 * (80 - both)))
        links = np.array(substring.link_sets(sets, 0.8)).T
        assert union_min(len(sets), *links).tolist() == want.tolist()


def test_last_round_of_a_block_is_not_learned(monkeypatch):
    """Half of a block's ids are of its last round, by which nothing more is coded; the bytes are as they were."""
    ids = (np.arange(200_000, dtype=np.int64) ** 2 // 7 % 1009).astype(np.int32)
    learned, real = [], tokenfile._Model.update
    monkeypatch.setattr(tokenfile._Model, "update", lambda self, before, *args: learned.append(len(before)) or real(self, before, *args))
    block = tokenfile.encode_block(ids, 1009)
    assert zlib.crc32(block) == 1981896364 and sum(learned) <= len(ids) // 2
    learned.clear()
    assert np.array_equal(tokenfile.decode_block(block), ids) and sum(learned) <= len(ids) // 2


@pytest.mark.parametrize("entries", [1, 100, 1 << 17])
def test_link_buckets_by_all_pairs(monkeypatch, entries):
    monkeypatch.setattr(substring, "ENTRIES", entries)
    r = random.Random(8)
    for _ in range(40):
        base = [r.sample(range(500), r.randint(1, 30)) for _ in range(3)]
        sets = [np.unique(np.array([x if r.random() < 0.95 else r.randrange(500) for x in r.choice(base)], np.uint64)) for _ in range(r.randint(0, 30))]
        bucket = np.sort(np.array([r.randrange(4) for _ in sets], np.uint64))
        want = [(i, j) for j in range(len(sets)) for i in range(j) if bucket[i] == bucket[j] and (x := len(np.intersect1d(sets[i], sets[j]))) >= 0.8 * (len(sets[i]) + len(sets[j]) - x)]
        i, j = substring.link_buckets(np.concatenate([np.zeros(0, np.uint64), *sets]), np.array([len(s) for s in sets], np.int64), bucket, 0.8)
        assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(want)


def calls_of(run):
    """What a run gives, and how many functions it has called, those in C too."""
    n = 0

    def count(frame, event, arg):
        nonlocal n
        n += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        return list(run), n
    finally:
        sys.setprofile(None)


def test_paragraphs_are_compared_without_a_call_for_each():
    """Lines with an edited copy each: all are compared in whole arrays, so fewer functions are called than there are paragraphs."""
    r = random.Random(9)
    lines = [[f"w{r.randrange(10**9)}" for _ in range(14)] for _ in range(1500)]
    every = [" ".join(x) for x in lines] + [" ".join([*x[:-1], "edited"]) for x in lines]
    texts = ["\n".join(every[i : i + 50]).encode() for i in range(0, len(every), 50)]
    text, place, key, _ = substring.find_keys(texts)
    keys, times = np.unique(key, return_counts=True)
    twice = np.isin(key, keys[times > 1])
    blobs = [np.unique(place[(text == k) & twice] * 2 + 1).astype("<u4").tobytes() for k in range(len(texts))]
    step = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array([0] * len(texts), pa.int32()), pa.array(texts, pa.binary()), pa.array(blobs, pa.binary())], names=["doc", "tie", "text", "places"])
    known = types.SimpleNamespace(value=(keys[:0], times[:0]))
    sent, sending = calls_of(substring._collide(1, known)([step]))
    found, judging = calls_of(substring._judge(1, 0.8)(sent))
    number = {}
    for k, p in substring._groups(texts):
        number |= {(c, h): ((t + k) * 50 + texts[t + k].count(b"\n", 0, a), kind) for t, a, kind, c, h in zip(p.text.tolist(), p.start.tolist(), p.kind.tolist(), p.content.view(np.int64).tolist(), p.check.view(np.int64).tolist(), strict=True)}
    links = [(number[r["content"], r["check"]], number[r["other"], r["other_check"]]) for b in found for r in b.to_pylist() if r["other"] is not None]
    assert all(abs(a - b) == 1500 and k == m for (a, k), (b, m) in links) and len(links) == len(set(links)) >= 0.98 * 2 * 1500
    assert sending < 3000 and judging < 3000, (sending, judging)


def chains_of(field, emission):
    """Every chain of labels with its weight: all k^n of them."""
    n, k = emission.shape
    for ys in itertools.product(range(k), repeat=n):
        score = field.start[ys[0]] + sum(emission[t, y] for t, y in enumerate(ys)) + sum(field.transition[a, b] for a, b in itertools.pairwise(ys))
        yield ys, np.exp(score)


def random_field(seed, k=3):
    r = np.random.default_rng(seed)
    field = langid.ChainField(["a", "b", "c"][:k], {})
    field.transition, field.start = r.normal(size=(k, k)), r.normal(size=k)
    return field, r


@pytest.mark.parametrize("row", [2, 3, 64])
def test_expectations_by_all_chains(row, monkeypatch):
    """Texts of 1 to 7 words, cut into rows of 2, 3 or 64, against the sum over all chains."""
    monkeypatch.setattr(langid, "ROW", row)
    field, r = random_field(7)
    counts = np.array([1, 5, 7, 2, 3, 6])
    emission = r.normal(size=(int(counts.sum()), 3))
    got, moves = field._expect(emission, counts, True)
    want_moves, at = np.zeros((3, 3)), 0
    for n in counts:
        post, total, own = np.zeros((n, 3)), 0.0, np.zeros((3, 3))
        for ys, w in chains_of(field, emission[at : at + n]):
            total += w
            for t, y in enumerate(ys):
                post[t, y] += w
            for a, b in itertools.pairwise(ys):
                own[a, b] += w
        assert np.allclose(got[at : at + n], post / total, atol=1e-9)
        want_moves += own / total
        at += n
    assert np.allclose(moves, want_moves, atol=1e-9)


def test_singular_transitions_do_no_harm():
    """Equal rows make the transition matrix singular; the words then are independent but for the columns' weights."""
    field, r = random_field(3)
    field.transition[:] = field.transition[0]
    emission = r.normal(size=(70, 3))
    want = np.exp(emission + np.where(np.arange(70)[:, None] == 0, field.start, field.transition[0]))
    assert np.allclose(field.marginals(emission, np.array([70])), want / want.sum(axis=1, keepdims=True))


def test_gradient_is_that_of_the_likelihood():
    field, r = random_field(11)
    counts, gold = np.array([4, 1, 6]), r.integers(0, 3, 11)
    emission = r.normal(size=(11, 3))

    def likelihood():
        total, at = 0.0, 0
        for n in counts:
            weights = dict(chains_of(field, emission[at : at + n]))
            total += np.log(weights[tuple(gold[at : at + n])] / sum(weights.values()))
            at += n
        return total

    for value, up in zip((emission, field.transition, field.start), field.gradient(emission, counts, gold), strict=True):
        for place in np.ndindex(value.shape):
            value[place] += 1e-5
            more = likelihood()
            value[place] -= 2e-5
            less = likelihood()
            value[place] += 1e-5
            assert abs((more - less) / 2e-5 - up[place]) < 1e-6


def test_fit_learns_from_the_end_of_a_text():
    """Texts whose first 300 words are shared by both languages are told apart by their last ones."""
    common = [f"w{i}" for i in range(300)]
    examples = [([*common, *[f"{'ab'[y]}x{i % 7}" for i in range(40)]], y) for y in (0, 1) for _ in range(6)]
    field = langid.ChainField(["a", "b"], {}).fit(examples, rounds=30)
    assert field.predict([" ".join(["bx"] * 9), " ".join(["ax"] * 9)])[0] == ["b", "a"]


def test_machine_score_by_pairs():
    machine = quality.FactorisationMachine(rank=3)
    machine.w[:] = np.random.default_rng(1).normal(size=quality.DIM)
    rows, slots, values = quality.features([b"some words, some more", b""])
    got, _ = machine.raw(rows, slots, values, 2)
    for i in range(2):
        s, x = slots[rows == i], values[rows == i].astype(float)
        pairs = sum(float(machine.v[s[a]] @ machine.v[s[b]]) * x[a] * x[b] for a in range(len(s)) for b in range(a))
        assert abs(got[i] - (machine.bias + float(machine.w[s] @ x) + pairs)) < 1e-3


def test_quantiser_codes_are_balanced():
    x = np.random.default_rng(3).normal(size=(3000, 32))
    codes = embed.Quantiser(x).codes(x)
    shares = [(codes >> np.uint64(b) & np.uint64(1)).mean() for b in range(32)]
    assert 0.4 < min(shares) and max(shares) < 0.6


def test_packer_limits():
    out, r = [], random.Random(9)
    packer = pack.Packer(64, 4, 40, 32, 2, 0, out.append)
    total = {}
    for doc in range(300):
        n, prompt = r.randint(1, 64), r.randint(0, 30)
        total[doc] = n
        packer.add((doc, 0, np.arange(n, dtype="<u4"), n, prompt))
    packer.finish()
    seen, by = {}, {}
    for doc, start, n, crc, _, seq, offset, loss in out:
        assert crc == zlib.crc32(np.arange(start, start + n, dtype="<u4").tobytes())
        seen.setdefault(doc, []).append((start, n))
        s = by.setdefault(seq, [0, 0, 0])
        assert offset == s[0]
        by[seq] = [s[0] + n, s[1] + 1, s[2] + loss]
    for doc, pieces in seen.items():
        assert sum(n for _, n in pieces) == total[doc]
        assert [s for s, _ in sorted(pieces)] == np.cumsum([0, *[n for _, n in sorted(pieces)]])[:-1].tolist()
    assert len(seen) == 300 and all(t <= 64 and k <= 4 and loss <= 40 for t, k, loss in by.values())


@pytest.mark.parametrize("limits", [(64, 50, 64), (64, 3, 64), (64, 50, 20)])
def test_packer_takes_the_largest_dot_product(limits):
    """Every choice against all held examples, where tokens, segments or loss bind."""
    r, placed = random.Random(4), []
    packer = pack.Packer(*limits, 16, 64, 0, placed.append)
    best = packer.best

    def checked(room):
        slot = best(room)
        able = {i: np.array([len(x[2]), 1, pack.loss_of(x)]) for i, x in enumerate(packer.items) if x is not None}
        able = {i: float(d / limits @ (np.array(room) / limits)) for i, d in able.items() if (d <= room).all()}
        assert (slot < 0) == (not able) and (slot < 0 or able[slot] >= max(able.values()) - 1e-12)
        return slot

    packer.best = checked
    for doc in range(200):
        n = r.randint(1, 20)
        packer.add((doc, 0, np.arange(n, dtype="<u4"), n, r.randint(0, n)))
    packer.finish()
    sums = {}
    for _, _, n, _, _, seq, _, loss in placed:
        s = sums.setdefault(seq, [0, 0, 0])
        sums[seq] = [s[0] + n, s[1] + 1, s[2] + loss]
    assert all(x <= m for s in sums.values() for x, m in zip(s, limits, strict=True))
    assert sum(any(x == m for x, m in zip(s, limits, strict=True)) for s in sums.values()) > 5


@pytest.mark.parametrize("limits", [(12, 9, 12), (30, 2, 30), (30, 9, 6)])
def test_packer_against_every_partition(limits):
    """Uncut examples: as many groups as the best of all partitions needs, or one more."""
    r = random.Random(2)

    def fits(group):
        return all(sum(d[k] for d in group) <= limits[k] for k in range(3))

    def fewest(items):
        least = [len(items)]

        def go(i, groups):
            if len(groups) >= least[0]:
                return
            if i == len(items):
                least[0] = len(groups)
                return
            for g in groups:
                if fits([*g, items[i]]):
                    g.append(items[i])
                    go(i + 1, groups)
                    g.pop()
            go(i + 1, [*groups, [items[i]]])

        go(0, [])
        return least[0]

    for _ in range(25):
        demands = [(n, 1, r.randint(0, min(n, limits[2]))) for n in (r.randint(1, limits[0] // 2) for _ in range(7))]
        packer, groups = pack.Packer(*limits, 8, limits[0], 0, lambda row: None), []
        packer._write = lambda chosen, groups=groups: groups.append(chosen)
        for i, (n, _, loss) in enumerate(demands):
            packer.add((i, 0, np.zeros(n, "<u4"), n, n - loss))
        packer.finish()
        assert sum(map(len, groups)) == 7 and len(groups) <= fewest(demands) + 1


def test_words_of_benchmarks():
    assert decontaminate.words_of("Ab-c9 É_x".encode()) == [b"ab", b"c9", "É".encode(), b"x"]
    assert decontaminate.words_of(None) == []
