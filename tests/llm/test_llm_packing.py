import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelspark.llm.packing import _best_fit, configuration_lp, pack, plan_sequences, tokenise


def reference_ids(text):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    return [*tok.encode(text or "", add_special_tokens=False).ids, 2]


def test_pieces_and_places(documents, messy):
    got = pack(tokenise(documents(messy))).collect()
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in got)
    short = tokenise(documents(messy), bytes_per_id=2).collect()
    assert {(len(r.ids), r.length) for r in short} == {(2 * r.length, r.length) for r in short}
    want = Counter()
    for i, t in messy:
        ids = reference_ids(t)
        cut, start, piece = len(ids) % 1024 or 1024, 0, 0
        while start < len(ids):
            raw = np.array(ids[start:cut], dtype="<u4").tobytes()
            want[str(i), piece, start, cut - start, zlib.crc32(raw)] += 1
            start, cut, piece = cut, cut + 1024, piece + 1
    assert Counter((str(r.doc_id), r.piece, r.start, r.length, zlib.crc32(bytes(r.ids))) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" \n\t ab'sé1.!\x00　", max_size=40))
def test_cut_encoding_equals_whole(text):
    from panelspark.llm.packing import _encoder

    ids, width = _encoder("byte_bpe_50k.json")
    assert np.frombuffer(ids(text), dtype=width).tolist() == reference_ids(text)[:-1]


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 50), max_size=12))
def test_plan_holds_the_histogram(histogram):
    plan = plan_sequences(histogram, 60, iterations=40)
    held = Counter()
    for config, n in plan:
        assert n > 0 and sum(s * k for s, k in config.items()) <= 60
        for s, k in config.items():
            held[s] += n * k
    assert held == Counter(histogram)
    used = sum(n for _, n in plan)
    assert used <= sum(n for _, n in _best_fit(dict(histogram), 60))
    # never above a bound that first-fit keeps too: at most one sequence half empty or less
    total = sum(s * n for s, n in histogram.items())
    assert used <= 2 * total / 60 + 1
    if histogram:
        cover, bound = configuration_lp(histogram, 60, 40)
        assert bound <= used + 1e-6
        assert bound <= sum(x for _, x in cover) + sum(s * n for s, n in histogram.items()) / 60 + 1e-6


def spread(low, high, n, seed=1):
    return dict(Counter(np.random.default_rng(seed).integers(low, high, n).tolist()))


@pytest.mark.parametrize(
    "histogram, gap, gain",
    [
        (spread(257, 512, 100_000), 1.025, 0.95),  # three pieces a sequence only if chosen with care
        ({400: 3000, 300: 5000, 250: 2000, 90: 100}, 1.005, 0.9),
        (spread(1, 1024, 100_000), 1.001, 1.0),
        (spread(342, 701, 100_000), 1.025, 1.0),
    ],
)
def test_plan_against_the_dual_bound_and_best_fit(histogram, gap, gain):
    plan = sum(n for _, n in plan_sequences(histogram))
    _, bound = configuration_lp(histogram, 1024, 256)
    best_fit = sum(n for _, n in _best_fit(dict(histogram), 1024))
    assert bound <= plan <= min(bound * gap, best_fit * gain)


def test_large_pieces_stand_alone_and_the_bound_knows():
    histogram = {s: n for s, n in [*spread(580, 640, 40_000).items(), *spread(80, 130, 60_000).items()]}
    plan = sum(n for _, n in plan_sequences(histogram))
    _, bound = configuration_lp(histogram, 1024, 256)
    volume = sum(s * n for s, n in histogram.items()) / 1024
    assert plan == 40_000  # every large piece needs a sequence of its own
    assert volume * 1.2 < bound <= plan


def test_cover_covers_the_common_sizes():
    histogram = spread(257, 512, 100_000)
    cover, _ = configuration_lp(histogram, 1024, 64)
    held = Counter()
    for config, x in cover:
        assert x > 0 and sum(s * k for s, k in config.items()) <= 1024
        for s, k in config.items():
            held[s] += x * k
    rare = [s for s, n in histogram.items() if held[s] < n - 1e-6]
    assert sum(s * histogram[s] for s in rare) <= 0.002 * sum(s * n for s, n in histogram.items())


def test_plan_is_near_the_lower_bound():
    rng = np.random.default_rng(1)
    lengths = Counter(np.clip(rng.lognormal(5.5, 0.8, 20000).astype(int), 1, 1024).tolist())
    plan = plan_sequences(dict(lengths))
    bound = sum(s * n for s, n in lengths.items()) / 1024
    assert sum(n for _, n in plan) <= bound * 1.01 + 2


def test_pieces_that_pair_up_only_one_way():
    plan = plan_sequences({s: 40 for s in range(1, 100)}, 100)
    assert sum(n for _, n in plan) <= 40 * 99 / 2 * 1.01


def test_equal_lengths_that_first_fit_wastes():
    # 7 + 7 + 6 fill 20 exactly
    plan = plan_sequences({7: 200, 6: 100}, 20, iterations=100)
    assert sum(n for _, n in plan) == pytest.approx(100, abs=2)


def test_empty_table(documents):
    assert pack(tokenise(documents([]))).count() == 0


def test_program_keeps_its_steps_small():
    """The steps of the program hold the sizes of their configurations, not a dense table of all sizes."""
    import tracemalloc

    histogram = {s: 2000 - s for s in range(1, 1024)}
    tracemalloc.start()
    configuration_lp(histogram, 1024, 48)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6
