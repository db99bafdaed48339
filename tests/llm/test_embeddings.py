"""What op6 finds doesn't hang on the number of vectors."""

import numpy as np

from granary.llm import embed


def test_found_alike_at_any_size(spark, monkeypatch):
    """Failed while the tables' keys grew with the number of classes, here as for 2048 times as many: fewer pairs were found."""
    r = np.random.default_rng(2)
    base = embed.units(r.normal(size=(3000, 64)))
    noise = r.normal(size=base.shape)
    noise -= (noise * base).sum(axis=1, keepdims=True) * base
    every = np.concatenate([base, 0.9805 * base + np.sqrt(1 - 0.9805**2) * embed.units(noise)])
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(every)], "vec_id long, embedding array<double>, label int")
    want = {tuple(x) for x in embed.near_duplicates(df).collect()}
    assert sum(x[1] for x in want) >= 0.99 * 6000
    monkeypatch.setattr(embed, "BUCKET_ROWS", 1, raising=False)
    assert {tuple(x) for x in embed.near_duplicates(df).collect()} == want


def test_pairs_in_the_first_table_only():
    """Every pair within reach comes from the first table where it collides, in blocks compared with themselves and with others."""
    r = np.random.default_rng(3)
    codes = r.integers(0, 1 << 63, 400, np.uint64) & np.uint64(0x0303030303030303)
    vec = np.ones((400, 1))
    for width in (8, 12):
        found = [(int(a), int(b)) for t in range(embed.TABLES) for key in range(1) for a, b in zip(*embed._pairs(codes, vec, codes, vec, t, width, 0.5, 6, True), strict=True)]
        turned = lambda x, t: (x >> 8 * t | x << 64 - 8 * t) & (1 << width) - 1
        want = []
        for a in range(400):
            for b in range(a + 1, 400):
                x = int(codes[a] ^ codes[b])
                if x.bit_count() <= 6:  # a bucket is not asked for here, so a pair counts up to the table where it collides first
                    first = next((t for t in range(embed.TABLES) if not turned(x, t)), embed.TABLES - 1)
                    want += [(a, b)] * (first + 1)
        assert sorted(found) == want
