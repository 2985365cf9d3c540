"""Personal data: generators propose spans, boosted trees accept them (native: built-in functions only).

Exact rules (``BASE``) find spans that always stay. Broader generators propose what those
rules miss, such as a phone and a card number that stand side by side and make one
overlong run. Their candidates are scored by boosted trees over format and context; a
threshold per kind, set on candidates the trees were not fitted on, accepts them. The trees
are fitted on a bounded sample on the driver and run as expressions inside the scan, so a
document is read once and nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.llm import boosting
from reelmart.llm.common import fresh
from reelmart.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
CONTEXT = 16  # characters on either side that features see
STRIDE = 256  # spans of a document whose offsets are added up at a time


@dataclass(frozen=True)
class Generator:
    """A pattern for a kind; ``needs`` is a cheap test that every text with a match passes."""

    kind: str
    pattern: str
    needs: str
    base: bool


# Fixed patterns of the base rules, with possessive repeats and bounds that change no match
# but keep long runs linear.
GENERATORS = (
    Generator("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", True),
    Generator("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "[0-9]", True),
    Generator("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9]", True),
    Generator("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", True),
    Generator("email", r"[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++", r"[(\[]at[)\]]", False),
    Generator("card", r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})(?![0-9])", "[0-9]{4}", False),
    Generator(
        "phone",
        r"(?<![0-9])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)[\x20.-]?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{4}(?![0-9])",
        r"[0-9]{3,4}[\x20.-][0-9]{4}",
        False,
    ),
)
# Words that speak for a kind when they stand before a span; fixed values.
CUES = r"(?i)tel|phone|call|fax|mobile|card|visa|pay|account|mail|contact|host|server|addr"
PHONE_CUES = r"(?i)(?<![\p{L}])(?:t[eé]l|phone|call|fax|mobil|cell|contact|dial|ring|appel|llam|anruf|handy)"
OTHER_CUES = r"(?i)order|invoice|part|item|serial|version|isbn|ref|lot|batch|model|sign|id\s*[:=#]"
# What stands before examples that trees learn from: before personal data, some of it without a cue, and before other
# numbers, some of them with one; fixed values.
PLACES = {
    "email": ("mail: ", "contact ", "write to ", "mail me: ", "e-mail "),
    "card": ("card ", "visa: ", "pay with ", "card no. ", "account ", "charged to "),
    "phone": (
        "tel ", "tel. ", "Tel.: ", "phone: ", "Phone ", "call ", "call me at ", "please call ", "fax ", "Fax: ", "mobile ", "cell: ",
        "contact: ", "dial ", "Telefon ", "téléphone : ", "Handy ", "reach us on ",
    ),
}
OTHER_PLACES = (
    "order ", "order no. ", "invoice ", "part ", "item ", "serial ", "version ", "ISBN ", "ref. ", "lot ", "batch ", "id=", "id: ", "the ",
    "of ", "about ", "from ", "und ", "= ", "", "phone model ", "call sign ",
)


def check_digit(number: str) -> str:
    """The digit that makes ``number`` pass the check of cards."""
    return str(-sum(sum(divmod(2 * int(c), 10)) if k % 2 == 0 else int(c) for k, c in enumerate(reversed(number))) % 10)


# Spans that examples are made of besides those of the table, so that a table without any has both labels; fixed values.
SEEDS = {
    "email": [f"{'abcdefgh'[k % 8]}{('', '.b', f'_x{7 * k}')[k % 3]}@{('c.org', f'host{k}.example.com', 'd-e.net', f'm{k}.de')[k % 4]}" for k in range(60)],
    "card": [n + check_digit(n) for n in (str(4_000_000_000_000_000 + 317_351_842_719 * k)[: 15 - k % 2 * (k % 4 == 1)] for k in range(1, 61))],
    "phone": [
        (f"+1 ({201 + 13 * k}) 555-{1007 + 149 * k}", f"+49 {30 + k} {1234 + 97 * k} {5678 + 53 * k}", f"+1-{203 + 11 * k}-{301 + 7 * k}-{2345 + 119 * k}")[k % 3]
        for k in range(60)
    ],
}


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """13 to 19 digits whose weighted sum is a multiple of ten."""

    def sums(number: Column) -> Column:
        figure = lambda i: F.substr(number, F.length(number) + 1 - i, F.lit(1)).cast("int")
        value = lambda i: F.when(i % 2 == 1, figure(i)).otherwise(F.floor(figure(i) / 5).cast("int") + figure(i) * 2 % 10)
        total = F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda s, i: s + value(i))
        return F.when(F.length(number).between(13, 19), total % 10 == 0).otherwise(F.lit(False))

    return bound(digits(text), sums)


def small_octets(text: Column) -> Column:
    bare = lambda part: F.regexp_replace(part, "^0+(?=[0-9])", "")
    return F.forall(F.split(text, r"\."), lambda p: (F.length(bare(p)) <= 3) & (F.coalesce(bare(p).try_cast("int"), F.lit(999)) <= 255))


def passes(kind: str, match: Column) -> Column:
    """The hard rule of a kind."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return small_octets(match)
    if kind == "card":
        return luhn(match)
    return F.length(digits(match)).between(9, 15)


def found(text: Column, generator: Generator) -> Column:
    """Struct of ``pieces`` between matches and ``matches``; one piece more than matches."""
    none = F.struct(F.array(text).alias("pieces"), F.array().cast("array<string>").alias("matches"))
    pieces, matches = F.split(text, generator.pattern, -1), F.regexp_extract_all(text, F.lit(generator.pattern), F.lit(0))
    return F.when(F.rlike(text, F.lit(generator.needs)), F.struct(pieces.alias("pieces"), matches.alias("matches"))).otherwise(none)


def running_ends(lengths: Column) -> Column:
    """Running sums of an array of long, block by block, so that long arrays cost little more than their length."""
    empty = F.array().cast("array<bigint>")
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.size(lengths) / STRIDE).cast("int") - 1, F.lit(0))),
        lambda b: F.aggregate(
            F.slice(lengths, b * STRIDE + 1, STRIDE),
            F.struct(F.lit(0).cast("long").alias("sum"), empty.alias("all")),
            lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.concat(s["all"], F.array(s["sum"] + x)).alias("all")),
        ),
    )
    joined = F.aggregate(
        blocks,
        F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<array<bigint>>").alias("all")),
        lambda s, b: F.struct((s["sum"] + b["sum"]).alias("sum"), F.concat(s["all"], F.array(F.transform(b["all"], lambda x: x + s["sum"]))).alias("all")),
    )
    return F.flatten(joined["all"])


def placed(parts: Column, number: int, generator: Generator) -> Column:
    """Array of candidates with their places in code points and some context."""
    lengths = F.transform(parts["matches"], lambda m, i: (F.length(F.get(parts["pieces"], i)) + F.length(m)).cast("long"))

    def candidates(ends: Column) -> Column:
        return F.transform(
            parts["matches"],
            lambda m, i: F.struct(
                F.lit(number).alias("generator"),
                (F.get(ends, i) - F.length(m)).alias("start"),
                F.get(ends, i).alias("end"),
                m.alias("match"),
                F.right(F.get(parts["pieces"], i), F.lit(CONTEXT)).alias("before"),
                F.left(F.get(parts["pieces"], i + 1), F.lit(CONTEXT)).alias("after"),
                passes(generator.kind, m).alias("valid"),
            ),
        )

    return bound(running_ends(lengths), candidates)


def masked(text: Column, parts: Column, generator: Generator) -> Column:
    """The text with valid matches blanked by as many control characters: places stay the same."""
    blank = lambda m, i: F.when(passes(generator.kind, m), F.repeat(F.lit("\x01"), F.length(m))).otherwise(m)
    return F.when(F.size(parts["matches"]) > 0, rebuilt(parts, blank)).otherwise(text)


def rebuilt(parts: Column, change) -> Column:
    """The text again, with each match replaced by ``change(match, its number)``."""
    tails = F.transform(parts["matches"], lambda m, i: F.concat(change(m, i), F.get(parts["pieces"], i + 1)))
    return F.concat(F.get(parts["pieces"], F.lit(0)), F.array_join(tails, ""))


def with_candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_c0`` .. : the candidates of each generator.

    Generators that are not base look at the text without the base spans of their kind.
    """
    docs = docs.withColumn("_t", F.coalesce(F.col("text").cast("string"), F.lit("")))
    for k, generator in enumerate(GENERATORS):
        if generator.base:
            docs = docs.withColumn(f"_p{k}", found(F.col("_t"), generator))
            docs = docs.withColumn(f"_c{k}", placed(F.col(f"_p{k}"), k, generator))
    of_kind = {g.kind: k for k, g in enumerate(GENERATORS) if g.base}
    for k, generator in enumerate(GENERATORS):
        if not generator.base:
            base = of_kind[generator.kind]
            docs = docs.withColumn(f"_m{k}", masked(F.col("_t"), F.col(f"_p{base}"), GENERATORS[base]))
            docs = docs.withColumn(f"_p{k}", found(F.col(f"_m{k}"), generator))
            docs = docs.withColumn(f"_c{k}", placed(F.col(f"_p{k}"), k, generator))
    return docs.drop("_t", *[f"_p{k}" for k in range(len(GENERATORS))], *[f"_m{k}" for k in range(len(GENERATORS))])


def features(c: Column) -> list[Column]:
    """Format and context of one candidate, as numbers."""
    number = lambda condition: condition.cast("int").cast("double")
    match, before, after = c["match"], c["before"], c["after"]
    return [
        F.length(digits(match)).cast("double"),
        F.length(match).cast("double"),
        F.length(F.regexp_replace(match, r"[^\x20-]", "")).cast("double"),
        number(F.startswith(match, F.lit("+"))),
        number(F.contains(match, F.lit("("))),
        number(luhn(match)),
        number(F.rlike(match, F.lit(r"^[0-9.]+$")) & small_octets(match)),
        number(F.contains(match, F.lit("@")) | F.contains(match, F.lit("at"))),
        F.length(F.regexp_replace(match, r"[^.]", "")).cast("double"),
        number(F.rlike(before, F.lit(r"[0-9][\x20().-]*$"))),
        number(F.rlike(after, F.lit(r"^[\x20().-]*[0-9]"))),
        number(F.rlike(before, F.lit(r"[A-Za-z=._-]$"))),
        number(F.rlike(after, F.lit(r"^[A-Za-z=_-]"))),
        number(F.rlike(before, F.lit(CUES))),
        number(F.rlike(before, F.lit(PHONE_CUES))),
        number(F.rlike(before, F.lit(OTHER_CUES))),
        number(F.rlike(match, F.lit(r"[A-Za-z]{2,}$"))),
    ]


def examples(generator: Generator, match: Column, own_before: Column, own_after: Column) -> Column:
    """Array of (candidate, label): what trees learn from, made of a span that the base rules found.

    The same span is written in other formats and put where it is personal data and where
    it is none. The label comes from how an example was made, not from its features: places
    without a cue hold some personal data, places with one some other numbers, and other
    numbers pass the check of cards by chance.
    """
    number = digits(match)

    def one_of(choices: tuple[str, ...], salt: str) -> Column:
        return F.get(F.array(*map(F.lit, choices)), F.pmod(F.xxhash64(match, F.lit(salt)), F.lit(len(choices))).cast("int"))

    def made(written: Column, before: Column, after: Column, label: bool) -> Column:
        tail, head = F.right(before, F.lit(CONTEXT)), F.left(after, F.lit(CONTEXT))
        return F.struct(F.struct(written.alias("match"), tail.alias("before"), head.alias("after")).alias("c"), F.lit(label).alias("y"))

    rest, run = F.lit(" "), F.lit(" 4556")
    place = lambda salt: one_of(PLACES[generator.kind], salt)
    other = lambda salt: one_of(OTHER_PLACES, salt)
    if generator.kind == "email":
        user, host = F.substring_index(match, "@", 1), F.substring_index(match, "@", -1)
        hidden = [F.concat(user, F.lit(" (at) "), host), F.concat(user, F.lit("[at]"), F.replace(host, F.lit("."), F.lit("[dot]")))]
        clock = F.concat(F.lit("meet (at) "), F.pmod(F.xxhash64(match), F.lit(12)).cast("string"), F.lit(".30"))
        return F.array(
            *[made(h, b, rest, True) for k, h in enumerate(hidden) for b in (own_before, place(f"e{k}"))],
            made(clock, own_before, rest, False), made(clock, place("e"), rest, False),
        )
    if generator.kind == "card":
        grouped = F.regexp_replace(number, "([0-9]{4})(?=[0-9])", "$1 ")
        turned = F.concat(F.right(number, F.length(number) - 5), F.left(number, F.lit(5)))  # a card by chance only
        last = F.right(number, F.lit(1)).cast("int")
        mistaken = F.concat(F.left(number, F.length(number) - 1), ((last + 1 + F.pmod(F.xxhash64(match), F.lit(9)).cast("int")) % 10).cast("string"))
        beside, before = F.concat(F.lit(" "), number), F.concat(number, F.lit(" "))
        return F.array(
            made(number, own_before, own_after, True), made(number, F.lit("+1 (269) 555-3296 "), rest, True), made(number, before, rest, True),
            made(number, own_before, beside, True), made(grouped, place("c1"), rest, True), made(number, place("c2"), rest, True), made(number, other("c3"), rest, True),
            made(turned, other("c4"), rest, False), made(mistaken, own_before, own_after, False), made(mistaken, before, rest, False),
            made(F.regexp_replace(mistaken, "([0-9]{4})(?=[0-9])", "$1 "), other("c5"), rest, False),
        )
    end = F.right(number, F.lit(4))
    middle, area = F.substr(number, F.length(number) - 6, F.lit(3)), F.substr(F.concat(F.lit("030"), number), F.length(number) - 6, F.lit(3))
    local = {sign: F.concat(area, F.lit(sign), middle, F.lit(sign), end) for sign in "- ."}
    local["long"] = F.concat(F.lit("0"), F.left(area, F.lit(2)), F.lit(" "), middle, F.left(area, F.lit(1)), F.lit(" "), end)
    bracketed = F.concat(F.lit("("), area, F.lit(") "), middle, F.lit("-"), end)
    beside = F.lit(" 4524132264652876")
    return F.array(
        made(match, own_before, own_after, True), made(match, own_before, beside, True), made(match, F.lit("4524132264652876 "), rest, True),
        made(match, other("p"), rest, True), made(bracketed, own_before, rest, True), made(bracketed, place("p("), beside, True),
        *[made(written, place(f"p{sign}"), rest, True) for sign, written in local.items()],
        *[made(written, other(f"o{sign}"), rest, False) for sign, written in local.items()],
        made(local["-"], place("p+"), beside, True),
        # pieces of longer numbers
        made(local["long"], one_of(PLACES["card"], "r"), run, False), made(local[" "], F.lit("12 "), run, False),
    )


@dataclass
class Model:
    """Trees and, for each kind, the least accepted score."""

    trees: boosting.Boosted
    thresholds: dict[str, float]

    def accepts(self, c: Column, generator: Generator) -> Column:
        if generator.base:
            return c["valid"]
        return bound(F.array(*features(c)), lambda x: self.trees.expression(lambda k: x[k])) >= F.lit(self.thresholds[generator.kind])


def fitted(candidates: DataFrame, documents: int = 2_000, per_document: int = 20) -> Model:
    """Trees from examples made of a bounded sample of base spans: of each kind ``documents`` different
    ones, of the first ``per_document`` of a document, and the fixed ones.

    Half of the examples fits the trees, the other half sets the thresholds.
    """
    sample = []
    for k, generator in enumerate(GENERATORS):
        if not generator.base or generator.kind not in SEEDS:
            continue
        valid = F.slice(F.filter(f"_c{k}", lambda c: c["valid"]), 1, per_document)
        found = candidates.select(F.explode(valid).alias("c")).groupBy("c.match").agg(F.min(F.struct("c.before", "c.after")).alias("own"))
        found = found.orderBy(F.xxhash64("match"), "match").limit(documents).select("match", "own.before", "own.after")
        fixed = F.array(*[F.struct(F.lit(m).alias("match"), F.lit("the ").alias("before"), F.lit(" and").alias("after")) for m in SEEDS[generator.kind]])
        seeds = found.unionByName(candidates.sparkSession.range(1).select(F.inline(fixed)))
        rows = F.transform(examples(generator, F.col("match"), F.col("before"), F.col("after")), lambda e: F.struct(F.array(*features(e["c"])).alias("x"), e["y"].alias("y")))
        sample += [(generator.kind, tuple(r["x"]), r["y"]) for r in seeds.select(F.inline(rows)).collect()]
    sample.sort(key=repr)
    kinds = np.array([s[0] for s in sample])
    x, y = np.array([s[1] for s in sample], float), np.array([s[2] for s in sample], float)
    half = np.random.default_rng(3).permutation(len(sample)) % 2 == 0
    trees = boosting.fit(x[half], y[half])
    score = trees.score(x)
    held = {k: ~half & (kinds == k) for k in KINDS}
    return Model(trees, {k: boosting.calibrated(score[m], y[m]) for k, m in held.items()})


def digest_columns(candidates: DataFrame, model: Model) -> DataFrame:
    """The counts, the hash of the base spans and all spans of each document."""
    kept = lambda k, generator: F.filter(f"_c{k}", lambda c: model.accepts(c, generator))
    accepted = {k: kept(k, g) for k, g in enumerate(GENERATORS)}
    names = {k: f"_a{k}" for k in accepted}
    spans = candidates.withColumns({names[k]: F.transform(a, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"))) for k, a in accepted.items()})
    base = {g.kind: names[k] for k, g in enumerate(GENERATORS) if g.base}
    every = {kind: [names[k] for k, g in enumerate(GENERATORS) if g.kind == kind] for kind in KINDS}
    written = lambda kind, column: F.transform(column, lambda s: F.concat(F.lit(kind + ":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))
    base_text = F.array_join(F.concat(*[written(k, F.col(base[k])) for k in KINDS]), ",")
    all_text = F.array_join(F.concat(*[written(k, F.array_sort(F.concat(*every[k]))) for k in KINDS]), ",")
    counts = [F.size(base[k]).cast("long").alias(f"n_{k}") for k in KINDS]
    return spans.select("doc_id", *counts, F.sha2(base_text, 256).alias("base_sha256"), all_text.alias("spans"))


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of each row of ``docs``.

    NULL text is empty and has no spans. Rows with equal or NULL ids stay separate; an empty
    table gives no rows; other columns are not read. Places are code points, end exclusive.
    """
    candidates = cut_lineage(with_candidates(docs.select("doc_id", "text")).drop("text"), "candidates")
    return digest_columns(candidates, fitted(candidates))


def redacted(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with each accepted span of ``text`` replaced by its kind in brackets; NULL text stays NULL.

    Generators take their turn on what the ones before have left, so no span is cut in two.
    """
    order = sorted(range(len(GENERATORS)), key=lambda k: (not GENERATORS[k].base, ("email", "phone", "card", "ip").index(GENERATORS[k].kind)))
    text, parts_name = fresh(docs, "_text"), fresh(docs, "_parts")
    out = docs.withColumn(text, F.col("text"))
    for k in order:
        generator = GENERATORS[k]
        parts = F.col(parts_name)
        out = out.withColumn(parts_name, found(F.coalesce(F.col(text), F.lit("")), generator))

        def change(m: Column, i: Column, parts: Column = parts, generator: Generator = generator) -> Column:
            c = F.struct(
                m.alias("match"),
                F.right(F.get(parts["pieces"], i), F.lit(CONTEXT)).alias("before"),
                F.left(F.get(parts["pieces"], i + 1), F.lit(CONTEXT)).alias("after"),
                passes(generator.kind, m).alias("valid"),
            )
            return bound(c, lambda c: F.when(model.accepts(c, generator), F.lit(f"[{generator.kind.upper()}]")).otherwise(c["match"]))

        out = out.withColumn(text, F.when(F.size(parts["matches"]) > 0, rebuilt(parts, change)).otherwise(F.col(text)))
    return out.withColumn("text", F.col(text)).drop(text, parts_name)
