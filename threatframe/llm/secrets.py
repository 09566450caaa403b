"""Secret scan: fixed patterns, and a battery of randomness tests over other long tokens. Column expressions only.

Fixed patterns are assignments to password-like names, access key ids and long hexadecimal runs. Besides, each run of 20 or
more characters of ``[A-Za-z0-9+/_-]``, with ``=`` at its end only (so that ``key=value`` is two runs), is a candidate when its characters are
those of one encoding: hex (digits and a-f, or A-F, also in groups of four or more joined by ``-``), base32 (A-Z, 2-7), base36 (0-9 and
a-z, or A-Z) or base64 (a capital and a small letter, with a digit or without). Of any other run each part of 20 or more letters
and digits is one; a part of digits, small or capital letters alone counts with p-value 1, as its kind never changes. Three tests judge a candidate:

* chi-squared: are the symbols of the inferred alphabet used evenly? (Wilson-Hilferty normal form.)
* runs: does the kind of character (digit, small, capital, other) change more often than in names made of words and
  numbers, where a change at one of five places is usual? Its upper tail is the candidate's p-value.
* serial correlation of neighbouring symbols.

A candidate that the first or third test finds far from random (p < 0.001) gets p-value 1. The others are controlled at the false
discovery rate ``fdr`` over all candidates of all documents: p-values are divided by the candidate's length over the mean
length (long tokens can be told apart, short ones hardly), and the step-up rule runs over a histogram of p-values in steps
of 10^-0.01, rounded to the safe side, so nothing but that small histogram meets in one place.

Offsets are in code points, end exclusive. Null text is empty. Rows are judged each by themselves, repeated ones too; other
columns are kept. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatframe.llm.common import unused
from threatframe.session import stage

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# a failing match of the next two is a whole run, so asking for the length at once gives the same matches
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}=*|[A-Za-z0-9+/_-]{19}=(?![A-Za-z0-9+/_=-])|[A-Za-z0-9+/_-]{18}==(?![A-Za-z0-9+/_=-])"
PART = r"[A-Za-z0-9]{20,}=*"
KINDS = ["assign", "access", "hex", "random"]
DIGITS, SMALL, CAPITAL = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# inferred encoding: (name, pattern of the whole run, alphabet)
ENCODINGS = [
    ("hex", "^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+=*$", DIGITS + "abcdef"),
    ("HEX", "^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+=*$", DIGITS + "ABCDEF"),
    ("base32", "^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$", CAPITAL + "234567"),
    ("base36", "^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+=*$", DIGITS + SMALL),
    ("BASE36", "^(?=.*[0-9])(?=.*[A-Z])[A-Z0-9]+=*$", DIGITS + CAPITAL),
    ("base64", "^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_-]+=*$", CAPITAL + SMALL + DIGITS + "+/"),
    ("letters64", "^(?=.*[a-z])(?=.*[A-Z])[A-Za-z+/_-]+=*$", CAPITAL + SMALL + "+/"),
    ("grouped hex", "^(?=.*[0-9])(?=.*[a-f])[0-9a-f]{4,}(?:-[0-9a-f]{4,})+=*$", DIGITS + "abcdef"),
    ("grouped HEX", "^(?=.*[0-9])(?=.*[A-F])[0-9A-F]{4,}(?:-[0-9A-F]{4,})+=*$", DIGITS + "ABCDEF"),
    ("digits", "^[0-9]+=*$", DIGITS),
    ("small", "^[a-z]+=*$", SMALL),
    ("capital", "^[A-Z]+=*$", CAPITAL),
]
BINS, PER_DECADE, BLOCK = 3000, 100, 4096


def scanned(values: Column, combine) -> Column:
    """Running results of ``combine`` over an array of integers, by steps that double: n log n for n items, where adding to an array item by item takes n * n."""
    n = F.size(values)

    def step(acc, j):
        return F.zip_with(acc, F.slice(F.concat(F.array_repeat(F.lit(0), F.pow(F.lit(2), j).cast("int")), acc), F.lit(1), n), combine)

    return F.when(n > 1, F.aggregate(F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(n, F.lit(2)))).cast("int") - 1), values, step)).otherwise(values)


def spans(text: Column, matches: Column, pattern: str) -> Column:
    """array<struct<s, e, m>> of the matches: the pieces between them give the places."""
    gaps = F.split(text, F.lit(pattern), -1)
    ends = scanned(F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda gap, m: F.length(gap) + F.length(m)), lambda a, b: a + b)
    found = F.zip_with(ends, matches, lambda e, m: F.struct((e - F.length(m)).alias("s"), e.alias("e"), m.alias("m")))
    return F.when(F.size(matches) > 0, found).otherwise(F.array().cast("array<struct<s:int,e:int,m:string>>"))


def apart(found: Column, base: Column) -> Column:
    """Those of the spans ``found`` that overlap none of ``base``: ends of the first and begins of the second in one order, with the largest end so far."""
    asked = F.transform(found, lambda x: F.struct(x["e"].alias("at"), F.lit(0).alias("of"), F.lit(0).alias("e"), x["s"].alias("s")))
    there = F.transform(base, lambda b: F.struct(b["s"].alias("at"), F.lit(1).alias("of"), b["e"].alias("e"), F.lit(0).alias("s")))
    row = F.array_sort(F.concat(asked, there))
    reach = scanned(F.transform(row, lambda x: x["e"]), lambda a, b: F.greatest(a, b))
    kept = F.filter(F.zip_with(row, reach, lambda x, r: F.struct(x["of"].alias("of"), x["s"].alias("s"), x["at"].alias("e"), r.alias("r"))), lambda x: (x["of"] == 0) & (x["r"] <= x["s"]))
    return F.when(F.size(base) == 0, F.transform(found, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))).otherwise(F.transform(kept, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))))


def upper_tail(z: Column) -> Column:
    """P(Z >= z) of the standard normal distribution; from 5 on by its asymptotic form, so that it never reaches 0."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    density = F.exp(-x * x / 2) / F.lit(2.5066282746310002)
    tail = F.when(x < 5, density * series).otherwise(density / F.greatest(x, F.lit(1.0)))
    return F.greatest(F.when(z >= 0, tail).otherwise(1 - tail), F.lit(1e-30))


def encoding_of(run: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, pattern, _ in reversed(ENCODINGS):
        out = F.when(run.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def candidates(runs: Column) -> Column:
    """array<struct<s, e, m, encoding>>: each run that fits an encoding, and the parts of each other run."""
    whole = F.transform(runs, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), encoding_of(x["m"]).alias("encoding")))

    def parts(x):
        inner = spans(x["m"], F.regexp_extract_all(x["m"], F.lit(PART), F.lit(0)), PART)
        moved = F.transform(inner, lambda y: F.struct((x["s"] + y["s"]).alias("s"), (x["s"] + y["e"]).alias("e"), y["m"].alias("m"), encoding_of(y["m"]).alias("encoding")))
        return F.when(x["encoding"].isNotNull(), F.array(x)).otherwise(moved)

    return F.flatten(F.transform(whole, parts))


def symbols_of(run: Column, encoding: Column) -> Column:
    """struct<body, symbols, alphabet> of a run: without padding and group marks, in the alphabet of its encoding."""
    plain = F.regexp_replace(run, "=+$", "")
    body = F.when(encoding.startswith("grouped"), F.replace(plain, F.lit("-"), F.lit(""))).otherwise(plain)
    alphabet = F.lit("")
    for name, _, letters in ENCODINGS:
        alphabet = F.when(encoding == name, F.lit(letters)).otherwise(alphabet)
    symbols = F.when(encoding.endswith("64"), F.translate(plain, "_-", "/+")).otherwise(body)
    return F.struct(body.alias("body"), symbols.alias("symbols"), alphabet.alias("alphabet"))


def p_value(run: Column, encoding: Column) -> Column:
    """p-value of a struct of ``symbols_of`` against 'a name made of words and numbers'. One expression for all encodings, as plans grow with it."""
    body, symbols, alphabet = (run[c] for c in ("body", "symbols", "alphabet"))
    n, size = F.length(body).cast("double"), F.length(alphabet).cast("double")
    squares = F.aggregate(F.split(alphabet, ""), F.lit(0.0), lambda acc, a: acc + F.pow((F.length(symbols) - F.length(F.replace(symbols, a, F.lit("")))).cast("double"), F.lit(2.0)))
    df = size - 1
    uneven = upper_tail((F.pow(F.greatest(squares * size / n - n, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))
    codes = F.transform(F.split(symbols, ""), lambda c: F.instr(alphabet, c).cast("double"))
    # sums of whole numbers, so that no lambda holds another sum and long runs take linear time
    total = F.aggregate(codes, F.lit(0.0), lambda acc, v: acc + v)
    spread = F.aggregate(codes, F.lit(0.0), lambda acc, v: acc + v * v) - total * total / n
    products = F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1), lambda a, b: a * b)
    ends = F.element_at(codes, 1) + F.element_at(codes, -1)
    together = F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v) - total / n * (2 * total - ends) + (n - 1) * (total / n) * (total / n)
    serial = together / F.greatest(spread, F.lit(1e-9)) * F.sqrt(n)
    kinds = F.split(F.translate(body, DIGITS + SMALL + CAPITAL + "+/_-", "0" * 10 + "a" * 26 + "A" * 26 + "...."), "")
    changes = F.zip_with(F.slice(kinds, 1, F.size(kinds) - 1), F.slice(kinds, 2, F.size(kinds) - 1), lambda a, b: F.when(a != b, 1.0).otherwise(0.0))
    z = (F.aggregate(changes, F.lit(0.0), lambda acc, v: acc + v) - 0.2 * (n - 1) - 0.5) / F.sqrt(0.16 * (n - 1))
    p = F.when((uneven < 0.001) | (upper_tail(F.abs(serial)) < 0.0005), F.lit(1.0)).otherwise(upper_tail(z))
    # a run of one kind has no change, so the runs test never finds it
    return F.when(encoding.isin("digits", "small", "capital"), F.lit(1.0)).otherwise(p)


def scan(docs: DataFrame, text_col: str = "text", fdr: float = 0.01, keep_text: bool = True) -> tuple[DataFrame, str]:
    """Every row of ``docs`` with a column of spans array<struct<kind, s, e>>, sorted by start, then kind as listed; and that column's name.

    ``kind`` is the place in ``KINDS``. The rows are written to the shared folder once, with candidates not yet decided; without
    ``keep_text`` that leaves the text out, and so does the result.
    """
    name, text = unused(docs, "spans"), F.coalesce(F.col(text_col), F.lit(""))
    inner = [unused(docs, f"__{k}") for k in KINDS]
    of_base, of_tried = unused(docs, "__base"), unused(docs, "__tried")
    low = F.lower(text)
    # cheap tests spare most texts the expressions; they hold for every text that could match
    hints = [low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api"), text.contains("AKIA"), F.lit(True), F.lit(True)]
    patterns = [ASSIGN, ACCESS, HEX, CANDIDATE]
    none = F.array().cast("array<string>")
    matched = [unused(docs, f"{c}_m") for c in inner]
    found = docs.withColumns({m: F.when(h, F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(none) for m, p, h in zip(matched, patterns, hints, strict=True)})
    found = found.withColumns({c: spans(text, F.col(m), p) for c, m, p in zip(inner, matched, patterns, strict=True)})
    long_enough = F.filter(inner[0], lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= 12)
    base = F.concat(*[of_kind(a, i) for i, a in enumerate([long_enough, F.col(inner[1]), F.col(inner[2])])])
    prepared = F.transform(F.filter(candidates(F.col(inner[3])), lambda x: x["encoding"].isNotNull()), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["encoding"].alias("encoding"), symbols_of(x["m"], x["encoding"]).alias("of")))
    tried = F.transform(prepared, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), p_value(x["of"], x["encoding"]).alias("p")))
    kept = [c for c in docs.columns if keep_text or c != text_col]
    rows = stage(found.select(*kept, base.alias(of_base), tried.alias(of_tried)))

    each = rows.select(F.explode(of_tried).alias("x")).select((F.col("x.e") - F.col("x.s")).alias("n"), F.col("x.p").alias("p"))
    totals = each.agg(F.count(F.lit(1)).alias("m"), F.avg("n").alias("mean")).first()
    limit = BINS + 1
    if totals.m:
        bins = each.select(bin_of(F.col("p"), F.col("n"), totals.mean).alias("bin")).groupBy("bin").count().collect()  # at most 3001 rows
        seen = 0
        for b, n in sorted(((r.bin, r["count"]) for r in bins), reverse=True):  # from the smallest p-value on
            seen += n
            if 10 ** (-b / PER_DECADE) * totals.m <= fdr * seen:
                limit = b
    likely = F.filter(of_tried, lambda x: bin_of(x["p"], x["e"] - x["s"], totals.mean or 1.0) >= limit)
    taken = apart(likely, F.col(of_base))
    by_place = F.array_sort(F.transform(F.concat(of_base, of_kind(taken, 3)), lambda x: F.struct(x["s"].alias("s"), x["kind"].alias("kind"), x["e"].alias("e"))))
    return rows.withColumn(name, by_place).drop(of_base, of_tried), name


def of_kind(found: Column, kind: int) -> Column:
    return F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e")))


def count_of(found: Column, kind: int) -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")


def bin_of(p: Column, n: Column, mean: float) -> Column:
    """Steps of 10^-0.01 down to the p-value over its weight, rounded to the larger p; no weight makes a p-value of 1 smaller."""
    return F.when(p >= 1, 0).otherwise(F.greatest(F.lit(0), F.least(F.lit(BINS), F.floor(-F.log10(p * F.lit(float(mean)) / n) * PER_DECADE).cast("int"))))


def listing(found: Column, last_kind: int = 3) -> Column:
    """``kind:start:end`` of the spans up to a kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    chosen = F.filter(found, lambda x: x["kind"] <= last_kind)
    return F.array_join(F.transform(chosen, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", fdr: float = 0.01) -> DataFrame:
    """``docs`` with every found span of the text replaced by ``mark``; overlapping spans become one. Null text stays null."""
    rows, name = scan(docs, text_col, fdr)
    text, found = F.col(text_col), F.col(name)
    # a span that begins before the end of those before it becomes one with them
    reach = scanned(F.transform(found, lambda x: x["e"]), lambda a, b: F.greatest(a, b))
    before = F.concat(F.array(F.lit(0)), reach)
    gaps = F.zip_with(before, F.concat(F.transform(found, lambda x: x["s"]), F.array(F.length(text))), lambda a, s: F.struct(a.alias("a"), s.alias("s")))
    # taken from blocks of the text, as a place in a long string is found by counting from its start
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def part(gap, pieces):
        inside = F.transform(F.sequence(F.floor(gap["a"] / BLOCK).cast("int"), F.floor((gap["s"] - 1) / BLOCK).cast("int")), lambda b: F.substring(
            F.element_at(pieces, b + 1), F.greatest(gap["a"] - b * BLOCK, F.lit(0)) + 1, F.least(gap["s"] - b * BLOCK, F.lit(BLOCK)) - F.greatest(gap["a"] - b * BLOCK, F.lit(0))))
        return F.when(gap["s"] > gap["a"], F.array_join(inside, "")).when(gap["s"] == gap["a"], F.lit(""))

    # as a lambda's variable the blocks are made once, and not for each part
    done = F.transform(F.array(blocks), lambda pieces: F.array_join(F.transform(gaps, lambda gap: part(gap, pieces)), mark))[0]
    return rows.withColumn(text_col, F.when(F.size(found) > 0, done).otherwise(text)).drop(name)
