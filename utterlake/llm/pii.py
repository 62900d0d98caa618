"""Personal data by weak supervision, with DataFrame functions only.

Candidates are the matches of the four base kinds (email, ip, card, phone) and of two wider ones (secret: long runs of
letters and digits; number: 9 to 19 digits that no base span covers). Five labelers vote on each candidate (1 for
personal, -1 against, 0 abstains): its shape, a gazetteer (top-level domains, calling codes, card issuers, token
prefixes), a checksum, the words before it, and its edges. Votes are counted by pattern over the whole corpus (a table of a few
hundred rows at most, whatever the corpus' size); expectation-maximisation on it estimates each labeler's
reliability per kind of answer, and a logistic span classifier is trained on the posteriors. The classifier's weights
become a SQL expression. Base spans always stay; a wider candidate stays where the classifier says so.

Positions come from what lies between matches: split() by a pattern gives the pieces, their lengths the offsets (code
points). The patterns are possessive or anchored to the ends of runs, which changes no match, but makes them linear
and keeps them off Java's stack.

Defined cases: a null text counts as empty (no spans, the digest of nothing); very long texts are searched whole; spans that begin at
one place are listed in the order of their kinds; every input row gives one output row, null ids and repeated rows included; an empty
table gives no rows; extra columns are ignored; with no candidates at all no classifier is trained.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterlake.llm.common import stored, table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "number")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+",
    "number": r"(?<![0-9.+-])[0-9](?:[\x20.-]?[0-9]){8,18}+(?![0-9])",
}
#: What a text must hold for a kind to be possible (found fast).
NEEDS = {"email": "@", "phone": "+"}
#: Words before a candidate that speak for it.
CONTEXT = {
    "email": r"(mail|contact|write|correo|adresse)",
    "ip": r"(\bip\b|host|server|address|login)",
    "card": r"(card|visa|master|amex|credit|carte|tarjeta|karte)",
    "phone": r"(phone|call|tel|fax|mobile|cell|sms)",
    "secret": r"(token|key|secret|passw|pwd|auth|bearer|credential|api)",
    "number": r"(phone|call|tel|fax|mobile|account|iban|card|ssn|social|passport|number)",
}
TOP_DOMAINS = "com org net edu gov mil int io co info biz de fr es uk us ru cn jp eu nl it ch at be ca au br in".split()
CALLING_CODES = r"^\+(1|7|20|27|3[0-46-9]|4[0-13-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65)"
TOKEN_PREFIXES = r"^(sk|pk|ghp|gho|xox[a-z]|AKIA|ASIA|eyJ|glpat)"
VOTES = ("shape", "gazetteer", "checksum", "context", "edge")
BLOCK = 256


def _part(n: str) -> str:
    return rf"0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5]){n}"


BYTES = r"^" + _part(r"\.") * 3 + _part("$")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((n - i) % 2 == 0, d).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def valid(kind: str, m: Column) -> Column:
    """Whether a match counts; a secret holds letters and digits, wherever in it they stand."""
    n = F.length(_digits(m))
    if kind == "secret":
        return m.rlike("[0-9]") & m.rlike("[A-Za-z]")
    if kind == "ip":
        return m.rlike(BYTES)
    if kind == "card":
        return F.when(n.between(14, 19), luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def votes(kind: str, m: Column, before: Column, after: Column) -> dict[str, Column]:
    """The labelers' votes on a candidate m between `before` (up to 40 characters) and `after` (one)."""
    yes, no, none = F.lit(1), F.lit(-1), F.lit(0)
    n = F.length(_digits(m))
    size = F.length(m)
    shape, gazetteer, checksum = yes, none, none
    if kind == "email":
        gazetteer = F.when(F.lower(F.substring_index(m, ".", -1)).isin(TOP_DOMAINS), yes).otherwise(no)
    elif kind == "ip":
        gazetteer = F.when(m.rlike(r"^(0|255)\."), no).otherwise(yes)
    elif kind == "card":
        gazetteer, checksum = F.when(_digits(m).rlike(ISSUERS), yes).otherwise(no), yes
    elif kind == "phone":
        gazetteer = F.when(m.rlike(CALLING_CODES), yes).otherwise(no)
    elif kind == "secret":
        shape = F.when(m.rlike("^[0-9a-fA-F]+$") & size.isin(32, 40, 48, 56, 64, 96, 128), yes).when(size >= 32, none).otherwise(no)
        gazetteer = F.when(m.rlike(TOKEN_PREFIXES), yes).otherwise(none)
        checksum = F.when((n / size).between(0.2, 0.85), yes).otherwise(no)
    else:
        shape = F.when(m.rlike(r"^([0-9]{3}[ .-][0-9]{3,4}[ .-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}|([0-9]{4}[ -]){3}[0-9]{4})$"), yes).otherwise(no)
        gazetteer = F.when(n.between(14, 19) & _digits(m).rlike(ISSUERS), yes).otherwise(none)
        checksum = F.when(n.between(14, 19), F.when(luhn(_digits(m)), yes).otherwise(no)).otherwise(none)
    context = F.when(F.lower(before).rlike(CONTEXT[kind]), yes).otherwise(none)
    open_before = (before == "") | F.substring(before, -1, 1).rlike("[^A-Za-z0-9_]")
    edge = F.when(open_before & ((after == "") | after.rlike("[^A-Za-z0-9_]")), yes).otherwise(no)
    return dict(zip(VOTES, (shape, gazetteer, checksum, context, edge), strict=True))


def _candidates(df: DataFrame, kind: str, text: str, out: str) -> DataFrame:
    """df with the array `out` of structs (start, end, kind, size, the votes) for one kind's matches in column `text`."""
    hits, pieces, sizes, offsets = f"{out}_hits", f"{out}_pieces", f"{out}_sizes", f"{out}_offsets"
    if kind in NEEDS:
        source = F.when(F.contains(F.col(text), F.lit(NEEDS[kind])), F.col(text))
    else:
        source = F.when(F.col(text).rlike("[0-9]"), F.col(text))
    pattern = PATTERNS[kind]
    df = df.withColumn(hits, F.regexp_extract_all(source, F.lit(pattern), F.lit(0)))
    some = F.size(F.coalesce(hits, F.array().cast("array<string>"))) > 0
    df = df.withColumn(pieces, F.when(some, F.split(F.col(text), pattern, -1)))
    df = df.withColumn(sizes, F.zip_with(F.slice(pieces, 1, F.greatest(F.size(hits), F.lit(0))), F.col(hits), lambda p, m: F.length(p) + F.length(m)))
    blocks = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int"))
    sums = F.transform(blocks, lambda b: F.aggregate(F.slice(F.col(sizes), b * BLOCK + 1, F.lit(BLOCK)), F.lit(0), lambda a, x: a + x))
    running = F.aggregate(sums, F.array(F.lit(0)), lambda a, x: F.array_append(a, F.element_at(a, -1) + x))
    df = df.withColumn(offsets, F.when(F.col(sizes).isNotNull(), running))

    def span(m: Column, i: Column) -> Column:
        b = F.floor(i / BLOCK).cast("int")
        within = F.aggregate(F.slice(F.col(sizes), b * BLOCK + 1, i - b * BLOCK), F.lit(0), lambda a, x: a + x)
        before = F.get(F.col(pieces), i)
        start = (F.get(F.col(offsets), b) + within + F.length(before)).cast("long")
        given = votes(kind, m, F.substring(before, -40, 40), F.substring(F.get(F.col(pieces), i + 1), 1, 1))
        return F.struct(
            start.alias("start"), (start + F.length(m)).alias("end"), F.lit(KINDS.index(kind)).alias("kind"),
            F.least(F.floor(F.length(m) / 16), F.lit(3)).cast("int").alias("size"), valid(kind, m).alias("valid"),
            *[v.cast("int").alias(k) for k, v in given.items()],
        )

    empty = F.array().cast(f"array<{SPAN}>")
    df = df.withColumn(out, F.coalesce(F.filter(F.transform(F.col(hits), span), lambda s: s["valid"]), empty))
    return df.drop(hits, pieces, sizes, offsets)


SPAN = "struct<start:bigint,end:bigint,kind:int,size:int,valid:boolean," + ",".join(f"{v}:int" for v in VOTES) + ">"


def with_candidates(df: DataFrame, text: str, base: str = "base", wide: str = "wide") -> DataFrame:
    """df with two arrays: the base spans and the wider candidates that touch none of them, both in order."""
    for kind in KINDS:
        df = _candidates(df, kind, text, f"{base}_{kind}")
    df = df.withColumn(base, F.array_sort(F.concat(*[F.col(f"{base}_{k}") for k in BASE]), _order))
    df = df.withColumn(wide, F.concat(F.col(f"{base}_secret"), F.col(f"{base}_number")))
    for kind in BASE:
        df = _apart(df, wide, f"{base}_{kind}")
    return df.drop(*[f"{base}_{k}" for k in KINDS])


def _apart(df: DataFrame, wide: str, one: str) -> DataFrame:
    """df with those spans of `wide` that touch none of `one` (spans of one kind: in order, apart from each other).

    Both are sorted together, so that a span of `wide` knows how many of `one` begin before it or with it: only the last of
    these and the one after it can touch it.
    """
    place = lambda side: lambda s: F.struct(s["start"].alias("at"), F.lit(side).alias("side"), s.alias("span"))
    both = F.array_sort(F.concat(F.transform(one, place(0)), F.transform(wide, place(1))))
    own = F.filter(F.transform(both, lambda x, i: F.when(x["side"] == 1, F.struct(i.alias("i"), x["span"].alias("span")))), lambda x: x.isNotNull())
    told = F.transform(own, lambda x, j: F.struct((x["i"] - j).alias("before"), x["span"].alias("span")))
    touches = lambda x: (
        F.coalesce(F.get(one, x["before"] - 1)["end"] > x["span"]["start"], F.lit(False)) | F.coalesce(F.get(one, x["before"])["start"] < x["span"]["end"], F.lit(False))
    )
    kept = F.transform(F.filter(told, lambda x: ~touches(x)), lambda x: x["span"])
    return df.withColumn(wide, F.when((F.size(one) > 0) & (F.size(wide) > 0), kept).otherwise(F.col(wide)))


def _order(a: Column, b: Column) -> Column:
    """By start, then kind as listed."""
    return F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"]).cast("int")).otherwise(a["kind"] - b["kind"])


# ---- the model, on the table of patterns


def estimate(patterns: list[tuple[tuple[int, ...], int, int, float]], rounds: int = 40) -> list[float]:
    """Posterior of each pattern (votes, kind, size, rows) by expectation-maximisation from the majority vote."""
    post = []
    for v, *_ in patterns:
        post.append(min(max(0.5 + 0.15 * sum(v), 0.1), 0.9))
    for _ in range(rounds):
        yes = sum(p * n for p, (*_, n) in zip(post, patterns, strict=True)) + 1
        no = sum((1 - p) * n for p, (*_, n) in zip(post, patterns, strict=True)) + 1
        given: list[dict[tuple[int, int], float]] = []
        for j in range(len(VOTES)):
            told: dict[tuple[int, int], float] = {}
            for p, (v, _, _, n) in zip(post, patterns, strict=True):
                told[1, v[j]] = told.get((1, v[j]), 1.0) + p * n
                told[0, v[j]] = told.get((0, v[j]), 1.0) + (1 - p) * n
            given.append({k: c / ((yes if k[0] else no) + 3) for k, c in told.items()})
        for i, (v, *_) in enumerate(patterns):
            odds = math.log(yes / no) + sum(math.log(given[j].get((1, v[j]), 0.01) / given[j].get((0, v[j]), 0.01)) for j in range(len(v)))
            post[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return post


def _names(v: tuple[int, ...], kind: int, size: int) -> list[str]:
    return [f"{k}={x}" for k, x in zip(VOTES, v, strict=True)] + [f"kind={kind}", f"size={size}", "bias"]


def train(patterns: list[tuple[tuple[int, ...], int, int, float]], post: list[float], steps: int = 300, ridge: float = 1e-2) -> dict[str, float]:
    """Logistic weights of the span classifier, on soft labels; each pattern weighs as the root of its rows."""
    w: dict[str, float] = {}
    weight = [math.sqrt(n) for *_, n in patterns]
    total = sum(weight) or 1.0
    for _ in range(steps):
        grad: dict[str, float] = {}
        for (v, kind, size, _), y, n in zip(patterns, post, weight, strict=True):
            names = _names(v, kind, size)
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w.get(f, 0.0) for f in names)))))
            for f in names:
                grad[f] = grad.get(f, 0.0) + n * (p - y) / total
        for f, g in grad.items():
            w[f] = w.get(f, 0.0) - 2.0 * (g + ridge * w.get(f, 0.0))
    return w


def fit(spans: DataFrame) -> dict[str, float]:
    """Train on all candidates of a table with the arrays base and wide; {} if it has none."""
    each = spans.select(F.explode(F.concat("base", "wide")).alias("s"))
    keys = [F.col(f"s.{k}").alias(k) for k in (*VOTES, "kind", "size")]
    rows = each.groupBy(*keys).agg(F.count("*").alias("n")).collect()  # at most 3^5 * 6 * 4 rows
    patterns = sorted((tuple(r[k] for k in VOTES), r["kind"], r["size"], float(r["n"])) for r in rows)
    return train(patterns, estimate(patterns)) if patterns else {}


def accepted(span: Column, weights: dict[str, float]) -> Column:
    """The classifier's verdict on a candidate, as SQL."""
    total = F.lit(weights.get("bias", 0.0))
    for name in (*VOTES, "kind", "size"):
        for value in range(-1, 6):
            w = weights.get(f"{name}={value}")
            if w is not None:
                total = total + F.when(span[name] == value, F.lit(w)).otherwise(F.lit(0.0))
    return total > 0 if weights else F.lit(False)


def _told(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def all_spans(weights: dict[str, float]) -> Column:
    """Base spans and accepted wider ones, by start, then kind."""
    return F.array_sort(F.concat("base", F.filter("wide", lambda s: accepted(s, weights))), _order)


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, counts of base spans, base_sha256, spans, and counts of all and of the wider kinds' spans."""
    read = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = stored(with_candidates(read, "text").select("doc_id", "base", "wide"), "spans")
    weights = fit(found)
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    wider = lambda k: F.size(F.filter("all", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return found.withColumn("all", all_spans(weights)).select(
        "doc_id", *[number(k) for k in BASE], F.sha2(_told(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _told(F.col("all")).alias("spans"), F.size("all").cast("long").alias("n_spans"), *[wider(k) for k in KINDS if k not in BASE],
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span (overlapping ones joined) replaced by its kind in brackets."""
    labels = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(a: Column, s: Column) -> Column:
        more = F.concat(a["parts"], F.array(F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.get(labels, s["kind"])))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(s["start"] >= a["at"], more).otherwise(a["parts"]).alias("parts"))

    last = lambda a: F.concat(F.array_join(a["parts"], ""), F.substring(text, (a["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, last)).otherwise(text)


def op7_pii(spark, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
