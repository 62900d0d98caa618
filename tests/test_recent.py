import math
import random
import time

from utterlake.functions.recent import RecentTexts
from utterlake.operators.clean import alike


def plain(rows, least):
    """Every row against all kept ones."""
    kept, out = [], []
    for text, start, window in rows:
        kept = [k for k in kept if start - k[1] <= k[2]]
        near = [k[0] for k in kept if start - k[1] <= window]
        out.append(text in near or any(alike(text, other, least) for other in near))
        if not out[-1]:
            kept.append((text, start, window))
    return out


def anchored(rows, least):
    kept, out = RecentTexts(least), []
    for text, start, window in rows:
        kept.expire(start)
        out.append(kept.near(text, start, window))
        if not out[-1]:
            kept.keep(text, start, window)
    return out


def test_like_all_against_all():
    rng = random.Random(3)
    for trial in range(150):
        base = "".join(rng.choice("ab ") for _ in range(rng.choice((20, 60, 700))))
        rows, at = [], 0.0
        for _ in range(60):
            at += rng.choice((0.0, 0.5, 3.0, 6.0, 40.0, 91.0)) if trial % 3 or rng.random() < 0.8 else rng.choice((-50.0, -7.0))
            n = rng.randint(1, len(base))
            text = base[(a := rng.choice((0, rng.randrange(len(base))))) : a + rng.choice((n, len(base)))]
            text += rng.choice(("", "", "x", "yy"))
            rows.append((text, math.nan if trial % 5 == 4 and rng.random() < 0.1 else at, 6.0 if len(text) <= 15 else 90.0))
        assert anchored(rows, 15) == plain(rows, 15)
        assert any(plain(rows, 15))


def test_nothing_is_left_when_all_has_expired():
    kept = RecentTexts(15)
    for i in range(50):
        kept.keep(f"a text that is long enough {i}", float(i), 90.0)
    kept.expire(1000.0)
    assert not (kept.alive or kept.equal or kept.begins or kept.holds)


def test_many_different_texts_in_one_window():
    def took(n):
        rng = random.Random(n)
        rows = [(" ".join(f"{rng.randrange(10**6)}" for _ in range(8)), i / n, 90.0) for i in range(n)]
        began = time.process_time()
        assert sum(anchored(rows, 15)) == 0
        return time.process_time() - began

    took(1000)
    assert took(100_000) < 60 * max(took(5_000), 0.05)  # quadratic: 400 times


def test_very_long_texts():
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh") for _ in range(200_000))
    rows = [(text, 0.0, 90.0), (text[30_000:], 1.0, 90.0), (text[:-30_000], 2.0, 90.0), (text[50_000:], 3.0, 90.0), (text[50_000:] + "z", 4.0, 90.0)]
    assert anchored(rows, 15) == plain(rows, 15) == [False, True, True, False, True]
