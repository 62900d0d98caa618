"""Each operator on nulls, empty and long texts, repeated rows, empty tables and columns with clashing names."""

import hashlib
import zlib

import numpy as np
import pytest

import corpus_pipeline
from utterlake.llm import byte_bpe, common, html_text, license_scan, media_store, near_dup, packing, pii, quality_crf, quality_rules, toxicity

LONG = "one two three four five six seven eight nine ten. " * 6000
ROWS = [
    (1, LONG), (2, None), (3, ""), (4, "Released under the MIT License. Mail a.b@c.org now, all of you good people here"), (4, "  \n\t"), (None, "hello world"),
    (5, "same words here again"), (5, "same words here again"), (6, "naïve café 漢字 😀 \x1c \x85  end"), (7, None),
]
NAMES = "score double, node string, row string, text_a string, bin int, held_out int, key string"


def docs(spark, rows=ROWS):
    """doc_id, text, and columns with names that operators use inside."""
    return spark.createDataFrame([(*r, 0.5, "n", "r", "t", 1, 2, "k") for r in rows], f"doc_id long, text string, {NAMES}")


def labels(spark):
    rows = [(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(100, 160)] + [(None, 1, 1), (200, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def labelled(spark):
    clean, junk, bad = "a plain sentence with words that go on. And some more of it here.\n", "X!! Y!! | Z$$ ##\n", "you are an idiot and a fool today.\n"
    rows = [(i, (clean if i % 3 else junk) * 3 + (bad if i % 5 == 0 else "") + f"n{i}") for i in range(100, 160)]
    return docs(spark, [*ROWS, *rows])


def by_row(df, key):
    return sorted((r.doc_id is None, r.doc_id or 0, *[getattr(r, k) for k in key]) for r in df.collect())


def test_near_dup(spark):
    got = near_dup.near_duplicates(docs(spark))
    assert got.count() == len(ROWS)
    rows = {(r.doc_id, r.n_shingles): r for r in got.collect()}
    assert rows[2, 0].component_id == 2 and rows[2, 0].kept and rows[3, 0].kept
    assert rows[5, 1].component_id == 5 and not rows[None, 1].kept and rows[None, 1].component_id is None
    assert near_dup.near_duplicates(docs(spark, [])).count() == 0


def test_near_dup_chain_and_ties(spark):
    base = [f"w{i}" for i in range(60)]
    change = lambda words, at: words[:at] + ["other"] + words[at + 1 :]
    rows = [(10, " ".join(base)), (3, " ".join(change(base, 0))), (7, " ".join(change(base, 0)).upper()), (12, " ".join(change(change(base, 0), 59))), (20, "far away words " * 3)]
    got = {r.doc_id: (r.component_id, r.kept) for r in near_dup.near_duplicates(docs(spark, rows)).collect()}
    assert got == {10: (3, False), 3: (3, True), 7: (3, False), 12: (3, False), 20: (20, True)}


def test_near_dup_like_brute_force(spark):
    rng = np.random.default_rng(1)
    rows, n = [], 0
    for _ in range(12):
        base = [f"w{rng.integers(5000)}" for _ in range(int(rng.integers(5, 120)))]
        for _ in range(10):
            words = list(base)
            for _ in range(int(rng.integers(0, max(2, len(base) // 20)))):
                words[int(rng.integers(len(words)))] = f"x{rng.integers(5000)}"
            rows.append((n, " ".join(words)))
            n += 1
    sets = {d: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for d, t in rows}
    root = {d: d for d in sets}
    for _ in range(len(rows)):
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if a < b and 100 * both >= 75 * len(sets[a] | sets[b]) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
        if not changed:
            break
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in near_dup.near_duplicates(docs(spark, rows)).collect()}
    assert got == {d: (root[d], len(sets[d])) for d in sets}


def test_node_as_sql_and_in_python(spark):
    df = docs(spark)
    got = df.select("text", near_dup.node_column(df.text).alias("n")).filter("text is not null").collect()
    assert all(bytes(r.n) == near_dup.node_of(near_dup.words_of(r.text)) for r in got)


def test_corrected_estimate():
    rng = np.random.default_rng(3)
    for share in (0.2, 0.75, 0.95):
        both = rng.integers(0, 2**63, 4000, dtype=np.uint64)
        n = int(4000 * share)
        a = np.unique(np.concatenate([both[:n], rng.integers(0, 2**63, (4000 - n) // 2, dtype=np.uint64)]) * np.uint64(2))
        b = np.unique(np.concatenate([both[:n], rng.integers(0, 2**63, (4000 - n) // 2, dtype=np.uint64)]) * np.uint64(2))
        assert abs(near_dup.corrected_jaccard(near_dup.registers(a), near_dup.registers(b), len(a), len(b)) - share) < 0.15


def test_toxicity(spark):
    model = toxicity.fit(labelled(spark), labels(spark))
    got = toxicity.toxicity(docs(spark), model)
    assert got.count() == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.collect())
    assert toxicity.toxicity(docs(spark, []), model).count() == 0
    assert toxicity.fit(docs(spark, []), labels(spark)).weights == {}
    known = model.word_weights()
    assert model.score("you are an idiot and a fool", known) > 0.5 > model.score("we met women and muslims there", known)


def test_identity_terms_do_not_move_the_score():
    rows = [(f"the {g} idiot came by {i}.", 1) for i, g in enumerate(toxicity.IDENTITY)] + [(f"a calm day number {i}.", 0) for i in range(40)]
    model = toxicity.fit_texts(rows)
    known = model.word_weights()
    scores = [model.score(f"some {g} here.", known) for g in toxicity.IDENTITY]
    assert max(scores) < 0.5 and max(scores) - min(scores) < 0.2


def test_media(spark):
    got = media_store.media_columns(docs(spark))
    rows = got.collect()
    assert len(rows) == len(ROWS)
    texts = {}
    for doc_id, t in ROWS:
        texts.setdefault(doc_id, []).append(media_store.payload_of(t))
    for r in rows:
        fits = [p for n, p in texts[r.doc_id] if n == r.n_bytes and hashlib.sha256(p).hexdigest() == r.payload_sha256]
        assert fits and r.payload_bytes == len(fits[0]) and r.tail_crc32 == zlib.crc32(fits[0][-32:]) and r.width == 576
        assert r.media_bytes == r.length and r.media_sha256 == r.digest
    assert media_store.media_columns(docs(spark, [])).count() == 0


def test_media_by_other_readers(spark):
    """Shards are tar files, members are PNG images of the payload (read here chunk by chunk), features are counted plainly."""
    import math
    import struct
    import tarfile

    got = media_store.media_columns(docs(spark)).collect()
    by_digest = {}
    for shard in {r.shard for r in got}:
        with tarfile.open(shard.removeprefix("file://")) as tar:
            for m in tar.getmembers():
                by_digest[shard, m.offset_data] = (m.name, tar.extractfile(m).read())
    plain = {}
    for doc_id, t in ROWS:
        data = (t or "").encode()
        plain.setdefault(doc_id, []).append((len(data), data + b"\xff" * ((-len(data)) % 576 if data else 576)))
    for r in got:
        name, image = by_digest[r.shard, r.offset]
        assert name == f"{hashlib.sha256(image).hexdigest()}.png" and len(image) == r.length and image[:8] == b"\x89PNG\r\n\x1a\n"
        at, parts, head = 8, b"", None
        while at < len(image):
            n, kind = struct.unpack(">I4s", image[at : at + 8])
            body = image[at + 8 : at + 8 + n]
            assert struct.unpack(">I", image[at + 8 + n : at + 12 + n])[0] == zlib.crc32(kind + body)
            head, parts = (struct.unpack(">IIBBBBB", body), parts) if kind == b"IHDR" else (head, parts + body if kind == b"IDAT" else parts)
            at += 12 + n
        raw = zlib.decompress(parts)
        width, height = head[:2]
        rows = [raw[i * (width + 1) : (i + 1) * (width + 1)] for i in range(height)]
        assert head[2:] == (8, 0, 0, 0, 0) and (r.width, r.height, r.bit_depth) == (width, height, 8) and all(x[0] == 0 for x in rows)
        payload = b"".join(x[1:] for x in rows)
        assert (r.n_bytes, payload) in plain[r.doc_id]
        mean = sum(payload) / len(payload)
        counts = [payload.count(bytes([v])) for v in range(256)]
        entropy = sum(c / len(payload) * math.log2(len(payload) / c) for c in counts if c)
        assert f"mean={mean:.4f};" in r.feature and f"entropy={entropy:.4f};" in r.feature


def test_arrow_addresses():
    assert media_store.arrow_uri("file:/a/b") == "file:///a/b" and media_store.arrow_uri("file:///a/b") == "file:///a/b"
    with pytest.raises(Exception):
        media_store.arrow_uri("nothing://a/b")


def test_license(spark):
    got = license_scan.scan_licenses(docs(spark)).collect()
    assert [(r.doc_id, r.license, r.first_word) for r in got] == [(4, "mit", 0)]
    assert license_scan.scan_licenses(docs(spark, [])).count() == 0


@pytest.mark.parametrize("words", [12, 40, 300, 700])
def test_license_of_any_length(spark, words):
    text = " ".join(f"t{i}" for i in range(words))
    rows = [(i, "pad " * i + text + " end" * 50) for i in range(40)] + [(99, " ".join(f"t{i}" for i in range(words // 2)))]
    got = license_scan.scan_licenses(docs(spark, rows), {"long": text}).collect()
    assert sorted(r.doc_id for r in got) == list(range(40))


def test_bound_of_missed_templates():
    assert max(license_scan.missed(n) for n in range(1, 5000)) < 3e-6
    assert all(2 * license_scan.half_window(n) > 2.4 * n for n in range(1, 5000))


def test_templates_in_one_text_of_many_words():
    """All of LICENSES are found wherever they stand in a long text; the bands' minima are those of plain windows."""
    rng, known, index = np.random.default_rng(8), license_scan.WordHashes(), license_scan.Index(license_scan.LICENSES)
    for _ in range(5):
        words = []
        for name in rng.permutation(sorted(license_scan.LICENSES)):
            words += [f"w{x}".encode() for x in rng.integers(10**6, size=int(rng.integers(1, 60_000)))] + license_scan.words_of(license_scan.LICENSES[name])
        assert {m[0] for m in index.scan(words, known)} == set(license_scan.LICENSES)
    hashes = rng.integers(2**63, size=1001, dtype=np.uint64)
    for size, least in license_scan.band_minima(hashes, [2, 3, 8, 12, 64, 96]):
        for k in (0, 1, len(least) - 1):
            assert (least[k] == license_scan.banded(hashes[k * size : (k + 1) * size]).min(0)).all()


@pytest.mark.parametrize(("words", "changed"), [(3, 0), (5, 0), (6, 0), (7, 0), (8, 0), (9, 0), (12, 1), (40, 2), (200, 12), (2000, 90)])
def test_license_inside_long_texts(words, changed):
    """None is missed, with some words changed (at the end, so that three quarters of the shingles stay) or spread over windows."""
    rng, known = np.random.default_rng(words), license_scan.WordHashes()
    notice = [f"t{i}".encode() for i in range(words)]
    index = license_scan.Index({"t": b" ".join(notice).decode()})
    said = notice[: words - changed] + [b"other"] * changed
    for i in range(3000 if words < 100 else 150):
        pad = [f"w{x}".encode() for x in rng.integers(10**6, size=200 + 2 * words)]
        at = int(rng.integers(60, 140 + 2 * words))
        assert [m[0] for m in index.scan([*pad[:at], *said, *pad[at:]], known)] == ["t"], i


def test_packing(spark):
    from tokenizers import Tokenizer
    import public_tokenizers

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    marked = ["end of one<|endoftext|>start of two", "<|endoftext|>", "<|endoftext|><|endoftext|> x <|endoftext|", "a <|endoftext|>\n\n b", " <|ENDOFTEXT|> "]
    rows = ROWS + [(20 + i, t) for i, t in enumerate(marked)]
    got = packing.best_fit_packing(docs(spark, rows)).collect()
    want = []
    for doc_id, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        want += [(doc_id is None, doc_id or 0, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    fill = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 1024
    assert packing.best_fit_packing(docs(spark, [])).count() == 0


def test_bounds_and_best_fit():
    rng = np.random.default_rng(2)
    for _ in range(50):
        sizes = rng.integers(1, 101, int(rng.integers(1, 60)))
        bins, offsets = packing.best_fit_decreasing(sizes, 100)
        fill = np.bincount(bins, sizes)
        assert fill.max() <= 100 and packing.lower_bound(sizes, 100) <= len(fill)
    assert packing.lower_bound(np.array([51] * 7), 100) == 7 and packing.lower_bound(np.array([34, 34, 34]), 100) == 2


def test_bounds_steer_the_exchange(spark):
    """Certified partitions give up their emptiest bin only, others their bins with gaps; no piece is lost."""
    for lengths, certified in (([60] * 400, True), ([int(x) for x in np.random.default_rng(4).integers(20, 45, 600)], False)):
        rows = [(i, 0, 0, n, i) for i, n in enumerate(lengths)]
        pieces = common.stored(spark.createDataFrame(rows, packing.PIECE), "test-pieces")
        got = packing.pack(pieces, 100, part_items=50).collect()
        fill = {}
        for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
            assert r.offset == fill.get(r.sequence_id, 0)
            fill[r.sequence_id] = r.offset + r.length
        assert sorted((r.doc_id, r.length) for r in got) == sorted((i, n) for i, n in enumerate(lengths)) and max(fill.values()) <= 100
        bins, bound = packing.packed_bins(spark.createDataFrame(got, packing.PACKED.removesuffix(", open boolean")), 100)
        assert len(fill) == bins >= bound >= sum(lengths) / 100
        if certified:
            assert bins == bound == 400 and sum(r.sequence_id < 1 << 56 for r in got) >= 400 - 8


def test_equal_pieces_are_dealt_to_all_parts(spark):
    """Pieces of more than half a sequence end after one round, and repeated rows don't meet in one part."""
    pieces = common.stored(spark.createDataFrame([(7, 0, 0, 600, 1)] * 2000, packing.PIECE), "test-pieces")
    got = packing.pack(pieces, 1024, part_items=200).collect()
    assert len({r.sequence_id for r in got}) == 2000
    first = [r for r in got if r.sequence_id < 1 << 56]
    assert len(first) >= 2000 - 10 and len({r.sequence_id >> 24 for r in first}) == 10


def test_samples_are_bounded_before_they_are_collected(spark):
    rows = [(1, "a plain text", 1), (2, "junk", 0), (3, "x" * 5000, 0)]
    docs_ = spark.createDataFrame([(i, t) for i, t, _ in rows for _ in range(20_000 if i < 3 else 1)], "doc_id long, text string")
    labels_ = spark.createDataFrame([(i, y) for i, _, y in rows] * 3, "doc_id long, quality int")
    take = lambda **k: common.labelled_sample(docs_, labels_, "quality", common.F.lit(True), max_rows=10, **k)
    assert take(max_chars=1000) == [("a plain text", 1), ("junk", 0)]
    assert len(take(max_chars=10_000)) == 3 and sum(len(t) for t, _ in take(max_chars=10_000, max_total=100)) <= 100


def test_training_texts_of_many_lines_and_sentences():
    import tracemalloc

    good, bad = "a plain line of words that goes on.\n", "X!! Y!! |\n"
    rows = [(good * 16_000, 1), (bad * 3, 0), (good * 4, 1), (bad * 16_000, 0)]
    tracemalloc.start()
    try:
        model = quality_crf.fit_texts(rows, steps=20)
        assert model.score(good * 5) > 0.7 > model.score(bad * 5)
        rows = [("you are an idiot. " * 5000, 1)] * 12 + [("we are here today. " * 5000, 0)] * 12
        model = toxicity.fit_texts(rows, steps=20)
        assert model.score("an idiot", model.word_weights()) > model.score("here today", model.word_weights())
        assert tracemalloc.get_traced_memory()[1] < 400e6
    finally:
        tracemalloc.stop()


def test_padded_chains_hold_every_line():
    rng = np.random.default_rng(5)
    made = [rng.random((n, quality_crf.N_FEATURES)).astype(np.float32) for n in (1, 0, 7, 450, 3, 200, 201)]
    seen = {i: [] for i in range(len(made))}
    for text, x, mask in quality_crf.chains(made, longest=200, most=600):
        assert x.shape[0] * x.shape[1] <= 600 or x.shape[0] == 1
        for i, rows, m in zip(text, x, mask, strict=True):
            seen[int(i)].append(rows[m])
    for i, x in enumerate(made):
        got = np.concatenate(seen[i]) if seen[i] else np.zeros((0, x.shape[1]))
        assert sorted(map(tuple, got.tolist())) == sorted(map(tuple, x.tolist()))


def test_penalised_fit_like_plain_descent():
    """The counterfactual penalty lowers what a swapped term changes, and the loss stays near that of the fit without it."""
    rows = [(f"the {g} idiot came by {i}.", 1) for i, g in enumerate(toxicity.IDENTITY)] + [(f"a calm day {i}.", 0) for i in range(20)] + [(f"{g} idiot?", 1) for g in toxicity.IDENTITY[:8]]
    free, tied = toxicity.fit_texts(rows, counterfactual=0.0), toxicity.fit_texts(rows, counterfactual=2.0)

    def change(m):
        k = m.word_weights()
        return sum(abs(m.score(f"the {a} idiot", k) - m.score(f"the {b} idiot", k)) for a, b in zip(toxicity.IDENTITY, toxicity.IDENTITY[1:]))

    def right(m):
        k = m.word_weights()
        return sum((m.score(t, k) >= 0.5) == bool(y) for t, y in rows)

    assert change(tied) <= change(free) + 1e-9 and right(tied) == right(free) == len(rows)


def test_quality_crf(spark):
    model = quality_crf.fit(labelled(spark), labels(spark))
    got = quality_crf.quality(docs(spark), model)
    assert got.count() == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.collect())
    assert quality_crf.quality(docs(spark, []), model).count() == 0
    assert model.score("a plain sentence with words that go on.\nAnd more.") > 0.7 > model.score("X!! Y!! | Z$$ ##\n" * 4)


def test_marginals_like_enumeration():
    d, move = [0.3, -1.2, 2.0, -0.4], np.array([[0.5, -0.2], [-0.7, 0.9]])
    total, good = 0.0, np.zeros(4)
    for m in range(16):
        y = [m >> i & 1 for i in range(4)]
        p = np.exp(sum(v for v, k in zip(d, y, strict=True) if k) + sum(move[a, b] for a, b in zip(y, y[1:])))
        total += p
        good += p * np.array(y)
    assert np.allclose(quality_crf.marginals(d, move), good / total)


def test_pii(spark):
    got = pii.personal_data(docs(spark))
    rows = got.collect()
    assert len(rows) == len(ROWS)
    mail = next(r for r in rows if r.n_email)
    assert mail.doc_id == 4 and mail.spans == "email:37:46" and mail.base_sha256 == hashlib.sha256(b"email:37:46").hexdigest()
    assert all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows if not r.n_email)
    assert pii.personal_data(docs(spark, [])).count() == 0


@pytest.mark.parametrize("text", ["a" * 200_000, "1." * 100_000, "a@" + "b." * 100_000 + "c", "+1" + "(" * 100_000, "1 " * 100_000 + "x", "a@b.c " * 5000])
def test_pii_on_texts_that_are_hard_for_patterns(spark, text):
    assert pii.personal_data(docs(spark, [(1, text)])).count() == 1


def plain_spans(text):
    """The base spans by Python's own patterns."""
    import re

    def luhn(d):
        twice = [int(c) * 2 for c in d[-2::-2]]
        return (sum(int(c) for c in d[-1::-2]) + sum(x - 9 if x > 9 else x for x in twice)) % 10 == 0

    patterns = (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
    )
    out = []
    for k, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if (k == 0) or (k == 1 and all(int(p) <= 255 for p in m[0].split("."))) or (k == 2 and 14 <= len(d) <= 19 and luhn(d)) or (k == 3 and 10 <= len(d) <= 15):
                out.append((m.start(), k, m.end()))
    return ",".join(f"{pii.BASE[k]}:{a}:{b}" for a, k, b in sorted(out)), [sum(x[1] == k for x in out) for k in range(4)]


def test_base_spans_like_plain_patterns(spark):
    import random

    r = random.Random(4)
    parts = ["a@b.co", "x.y@z-w.org", "@", ".", "1.2.3.4", "256.1.1.1", "0255.1.2.3", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (212) 555-0100", "+44 20 7946 0958",
             "+1", "5", "12", " ", "-", "é", "😀", "漢", "\n", "a@b", "..", "++1.22-3333 44444", "378282246310005", "00004111111111111111", "_"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(1, 12))) for _ in range(1500)]
    got = pii.personal_data(docs(spark, list(enumerate(texts)))).collect()
    assert len(got) == len(texts)
    for x in got:
        spans, n = plain_spans(texts[x.doc_id])
        assert x.base_sha256 == hashlib.sha256(spans.encode()).hexdigest(), (texts[x.doc_id], spans, x.spans)
        assert [x.n_email, x.n_ip, x.n_card, x.n_phone] == n and set(spans.split(",")) - {""} <= set(x.spans.split(","))
        wide = [tuple(map(int, s.split(":")[1:])) for s in x.spans.split(",") if s.startswith(("secret", "number"))]
        base = [tuple(map(int, s.split(":")[1:])) for s in spans.split(",") if s]
        assert all(b <= c or d <= a for a, b in wide for c, d in base)


def test_secrets_of_any_make(spark):
    """Digits may stand anywhere in a run; runs of letters or of digits alone are no candidates."""
    runs = ["a" * 45 + "1234567890", "1" * 45 + "abcdefghij", "a" * 200_000 + "1", "a" * 60, "1" * 60, "a" * 18 + "1", "ab1" * 10]
    found = pii.with_candidates(docs(spark, [(i, f"the key {t} is secret") for i, t in enumerate(runs)]).select("doc_id", "text"), "text")
    got = {x.doc_id: [(s.start, s.end) for s in x.wide if s.kind == pii.KINDS.index("secret")] for x in found.collect()}
    assert got == {i: [(8, 8 + len(t))] if i in (0, 1, 2, 6) else [] for i, t in enumerate(runs)}


def test_many_spans_in_one_text(spark):
    text = "a@b.co token0123456789abcdefghij 1.2.3.4 " * 20_000
    got = pii.personal_data(docs(spark, [(1, text)])).first()
    assert got.n_email == got.n_ip == 20_000


def test_estimation_finds_the_reliable_labelers():
    """Votes drawn with known reliabilities: the posteriors tell the truth better than the majority, the span classifier follows them."""
    rng = np.random.default_rng(6)
    truth = rng.random(4000) < 0.4
    right = np.array([0.95, 0.9, 0.6, 0.55, 0.85])
    votes = np.where(rng.random((4000, 5)) < right, np.where(truth, 1, -1)[:, None], np.where(truth, -1, 1)[:, None])
    n, good = {}, {}
    for v, t in zip(map(tuple, votes.tolist()), truth, strict=True):
        n[v], good[v] = n.get(v, 0) + 1, good.get(v, 0) + int(t)
    patterns = [(v, 0, 0, float(c)) for v, c in sorted(n.items())]
    post = pii.estimate(patterns)
    share = lambda says: sum(good[p[0]] if s else p[3] - good[p[0]] for p, s in zip(patterns, says, strict=True)) / 4000
    majority = share([sum(p[0]) > 0 for p in patterns])
    assert share([x > 0.5 for x in post]) > max(0.95, majority)
    w = pii.train(patterns, post)
    assert share([sum(w.get(f, 0.0) for f in pii._names(*p[:3])) > 0 for p in patterns]) > 0.95


def test_html(spark):
    rows = [(1, "u", "<article><h1>T</h1><p>a  b &lt;c&gt;<p>d</article><footer>f</footer>"), (2, "u", None), (3, None, ""), (3, None, "just text"), (None, "u", "<nav>" + "<a>x</a>" * 9000)]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = html_text.extract_text(pages).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "", 0), (1, "T\na b <c>\nd", 11), (2, "", 0), (3, "", 0), (3, "just text", 9)]
    assert html_text.extract_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<html><head><title>t</title><meta charset=x><script>a</script><body><p>one two</p></body></html>", ["one two"]),
        ("<html><head><title>t</title><p>one two</p></html>", ["one two"]),
        ("<head><title>t</title></head><p>one</p>", ["one"]),
        ("<div><svg><path d='x'></div><p>one</p>", ["one"]),
        ("<div><script>x = 1</div><p>one</p>", ["one"]),
        ("<div><svg><g>a</g><svg>b</svg>c</svg>one</div>", ["one"]),
        ("<template><div>a<template>b</template>c</div></template><p>one</p>", ["one"]),
        ("<div><svg><div>a</div><script>'</div>'</script>b</svg>one</div>", ["one"]),
        ("<div><button>a<button>b</button>one</div>", ["one"]),
        ("<div><svg/>one</div>", ["one"]),
        ("<p>one</p><svg>never closed", ["one"]),
        ("<div><script>a</div>" * 9000 + "one", ["one"]),
    ],
)
def test_unclosed_and_nested_dropped_tags(page, want):
    assert [b.text for b in html_text.blocks(page)] == want


def test_linked_references_of_an_article_stay():
    tree = html_text.grow_tree(*html_text.labelled_blocks())
    item, text = "<li><a>" + "some words " * 4 + "</a></li>", "<p>" + "words of the text " * 10 + "</p>"
    assert html_text.main_text(f"<article>{text}<ul>{item * 3}</ul></article>", tree).count("\n") == 3
    assert "some" not in html_text.main_text(f"<article>{text}</article><nav><ul>{item * 3}</ul></nav>", tree)


LINE = "word " * 20


@pytest.mark.parametrize(
    ("page", "n"),
    [
        (f"<html><head><title>t</title><body><article><p>{LINE}</article>", 20),
        (f"<datalist><option>A<option>B</datalist><p>{LINE}", 20),
        (f"<article><p data-x=it's>{LINE}</p><p>{LINE}</p><p title=that's>{LINE}</p></article>", 60),
        (f"<article><p title='a > b' data-y=\"<p>\">{LINE}</p></article>", 20),
        (f'<div class="post-with-sidebar"><p>{LINE}</p></div>', 20),
        (f'<div class="tags-page content"><p>{LINE}</p></div>', 20),
        (f'<article class="discussion-of-results"><p>{LINE}</p></article>', 20),
        (f"<form id=aspnetForm><article><p>{LINE}</p></article></form>", 20),
        (f"<section class=alert><article><p>{LINE}</p></article></section>", 20),
        (f'<div class="sidebar-content"><p>{LINE}</p></div>', 0),
        (f"<article><p class=ad>x<div>{LINE}</div></article>", 20),
        (f"<article><ul><li class=ad>{LINE}<li>{LINE}</ul></article>", 20),
    ],
)
def test_pages_as_they_are_written(page, n):
    assert len(html_text.main_text(page, html_text.grow_tree(*html_text.labelled_blocks())).split()) == n


@pytest.mark.parametrize("part", ["<a ", "<a b='", '<a href="', "<b></i>", "<div></p>", "<p><svg>", "<!-- ", "<p><option>a", "<div><script>a</div>", "<ul><li>", "x<y ", "&amp"])
def test_reading_takes_time_in_proportion(part):
    import time

    began = time.process_time()
    html_text.blocks(part * (1_000_000 // len(part)))
    assert time.process_time() - began < 5


def test_tree_on_pages_drawn_anew():
    assert html_text.held_out_accuracy() > 0.95


def test_given_pages_like_another_parser(spark):
    """The article's text by the standard library's parser; the given pages have all of their text in one article."""
    import os
    from html.parser import HTMLParser

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables")

    class Article(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.inside, self.lines = False, [""]

        def handle_starttag(self, tag, attrs):
            self.inside = self.inside or tag == "article"
            if tag in html_text.BLOCK:
                self.lines.append("")

        def handle_endtag(self, tag):
            if tag in html_text.BLOCK:
                self.lines.append("")
            self.inside = self.inside and tag != "article"

        def handle_data(self, data):
            if self.inside:
                self.lines[-1] += data

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in html_text.extract_text(pages).join(pages.select("page_id", "html"), "page_id").collect():
        parser = Article()
        parser.feed(r.html)
        parser.close()
        assert r.text == "\n".join(t for t in (" ".join(x.split()) for x in parser.lines) if t) and r.n_chars == len(r.text)


def brute_rules(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def test_quality_rules(spark):
    texts = ["a b c d e f a b c d e x a b c d e", "x\nx\n \ny\nx", "é漢 #1 $ | <>", LONG[:3000], None, "", "p q r s t p q r s t p q r s t"]
    trees = quality_rules.fit(labelled(spark), labels(spark))
    got = quality_rules.quality_rules(docs(spark, list(enumerate(texts))), trees).collect()
    for r in got:
        want = brute_rules(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (r.base_failed and r.kept)
    assert quality_rules.quality_rules(docs(spark, []), trees).count() == 0
    assert quality_rules.fit(docs(spark, []), labels(spark)) is None


def test_trees_are_monotone():
    rng = np.random.default_rng(0)
    x = rng.random((800, 12))
    y = (x[:, 0] + 0.3 * rng.random(800) < 0.7).astype(float)
    trees = quality_rules.fit_trees(x, y)
    grid = np.repeat(rng.random((40, 12)), 30, axis=0)
    grid[:, 0] = np.tile(np.linspace(0, 1, 30), 40)
    assert (np.diff(trees.score(grid).reshape(40, 30), axis=1) <= 1e-12).all()


def test_byte_bpe(spark):
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = byte_bpe.byte_bpe(docs(spark))
    want = []
    for doc_id, t in ROWS:
        ids = enc.encode_ordinary(t or "")
        want.append((doc_id is None, doc_id or 0, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert by_row(got, ("n_tokens", "ids_sha256", "decoded_sha256")) == sorted(want)
    assert byte_bpe.byte_bpe(docs(spark, [])).count() == 0
    df = docs(spark)
    back = df.select("text", byte_bpe.decode_ids(byte_bpe.encode_ids(df.text)).alias("b")).collect()
    assert all(r.b == (r.text or "") for r in back)


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    labels(spark).write.parquet(f"{d}/labels.parquet")
    return d


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES[:-1])
def test_stages_keep_the_columns(spark, sf, name, stage):
    for df in (labelled(spark), docs(spark, [])):
        got = stage(spark, df, sf)
        assert got.columns == df.columns and [t for _, t in got.dtypes] == [t for _, t in df.dtypes]
        assert (got.count() > 0) == (df.count() > 0)


def test_near_dup_stage_keeps_one(spark, sf):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(3, text), (1, text), (1, text), (2, text + " more"), (None, text), (None, "own words of nobody"), (9, None), (8, "")]
    got = corpus_pipeline.near_dup_stage(spark, docs(spark, rows), sf).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "8", "9", "None"]


def test_near_dup_stage_keeps_different_texts_of_one_id(spark, sf):
    a, b, c = (" ".join(f"{k}{i}" for i in range(40)) for k in "abc")
    rows = [(5, a), (5, b), (5, b + " more"), (3, c), (5, c), (5, ""), (5, None), (5, a.upper())]
    got = corpus_pipeline.near_dup_stage(spark, docs(spark, rows), sf).collect()
    said = sorted((r.doc_id, (r.text or "").lower().removesuffix(" more")) for r in got)
    assert said == [(3, c), (5, ""), (5, a), (5, b)]


def test_pii_stage_redacts(spark, sf):
    df = spark.createDataFrame([(1, "mail a@b.org, é 1.2.3.4", "en", "s", 99), (2, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(corpus_pipeline.pii_stage(spark, df, sf).collect(), key=lambda r: r.doc_id)
    assert got[0].text == "mail [EMAIL], é [IP]" and got[0].n_chars == len(got[0].text) and got[1].text == ""


def test_pipeline_as_a_whole(spark, tmp_path):
    """Rows that repeat, texts that share an id, junk, toxic and personal texts through all stages, against what should be left."""
    clean = lambda k: " ".join(f"{k}{i}" + ("." if i % 9 == 8 else "") for i in range(120)) + ". And some more of it here."
    docs_ = labelled(spark).select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in docs_ if r.doc_id is not None and r.doc_id >= 100]
    rows += [(1, clean("a")), (1, clean("a")), (1, clean("b")), (2, clean("a") + " more"), (3, clean("c") + " Mail a.b@c.org now."), (4, "too short"), (5, None)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    before = {n for n in dir(common)}
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert before <= set(dir(common)) and not common._SCRATCH
    packed = got.collect()
    ids = {r.doc_id for r in packed}
    assert {1, 3} <= ids and not {2, 4, 5} & ids
    trees = quality_rules.fit(df, labels(spark))
    kept = df.filter(quality_rules.verdict(df.text, trees)["kept"])
    model = toxicity.fit(kept, labels(spark))
    kept = [(r.doc_id, r.text) for r in kept.filter(toxicity.score(kept.text, model) < 0.5).collect()]
    near = near_dup.near_duplicates(spark.createDataFrame(kept, "doc_id long, text string"))
    want = {r.component_id for r in near.collect()}
    assert ids == want
    fill = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 1024
