"""Personal data: base rules, and candidates that boosted trees accept.

Base rules find emails, IP addresses, card numbers and phone numbers by pattern and check. Beside them,
generators with loose patterns propose candidates, which may overlap: written-out emails, numbers with
other separators or without a plus, secrets. Gradient-boosted trees score candidates by their format
and what stands before them. They learn from seeds. True ones are candidates that the base rule of their own kind
confirms, values that a word such as "password" names, and addresses of eight groups. False ones are what a base rule
confirms as another kind, what fails a check that true ones pass (check digits, parts above 255, lengths, domain
endings), placeholders, numbers and capitals without a key word, hashes and ids of code, clock times. A threshold per
kind is calibrated on the seeds of texts that the trees were not fitted on, so that nearly all accepted ones are true;
a kind with few seeds leans on those of all kinds. Where that can't be reached, none is added.

Everything is built from column expressions. The trees become one too, so scoring needs no shuffle: a
document's candidates stay an array in its row. Sums along an array are made chunk by chunk (``running``), and spans
meet as one sorted array, so the work of a text grows little faster than its matches.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from operator import add, and_, or_

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.texts import text_of
from ledgermill.session import stored

# The order in which kinds are listed.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
# The base patterns. Possessive repeats and the look behind keep them linear on any text: they only spare starts
# from which the plain pattern can't match either, and steps back that never help it.
_LOCAL, _HOST = "A-Za-z0-9._%+-", "A-Za-z0-9-"
BASE_PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_HOST}]++(?:\.[{_HOST}]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for its pattern to be worth a search.
_HOLDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
# Generators: (kind, pattern). High recall; they need not be right.
GENERATORS = (
    ("email", rf"(?<![{_LOCAL}])[{_LOCAL}]++ ?(?:@|[\[(]at[\])]) ?[{_HOST}]++(?: ?(?:\.|[\[(]dot[\])]) ?[{_HOST}]++)++"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}(?![0-9.])"),
    ("ip", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    ("card", r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){12,18}(?![0-9])"),
    ("phone", r"(?<![0-9+])\+?[0-9(][0-9\x20().-]{6,18}[0-9](?![0-9])"),
    ("secret", r"(?i)(?<![a-z])(?:pass(?:word|wd)?|pwd|token|secret|api[_-]?key)[\"']? ?[=:] ?[\"']?[^\s\"'=]{6,}+"),
    ("secret", r"(?<![A-Za-z0-9])(?:[A-Z0-9]{16,}+|[0-9a-f]{16,}+)(?![A-Za-z0-9])"),
)
# What a text must hold for each of them to be worth a search: patterns that are all found in it.
_GENERATOR_HOLDS = (
    ("@|[\\[(]at[\\])]",),
    ("[0-9]\\.[0-9]",),
    ("[0-9A-Fa-f]:[0-9A-Fa-f]",),
    ("[0-9]",),
    ("[0-9]",),
    ("[=:]", "(?i)pass|pwd|token|secret|api"),
    ("[A-Z0-9]{16}|[0-9a-f]{16}",),
)
_KEY_WORDS = r"(?i)(?:pass|pwd|token|secret|key|tel|phone|call|mail|card|visa|host|server|ip)[a-z_]*[\"']?[\s:=]*$"
_ANCHORED = r"(?i)^(?:pass|pwd|token|secret|api)"
# What shows that a candidate is none: words in place of a secret, names of hashes, dates, clock times.
_PLACEHOLDER = r"(?i)[=:] ?[\"']?(?:[x*.#_-]+|(?:your|my|example|change|redacted|hidden|none|null|true|false|undefined|<)[^\s]*)$"
_CODE = r"(?i)(?:commit|sha[0-9-]*|md5|hash|checksum|digest|uuid|guid|revision|build|isbn|id)[\"']?[\s:=#]*$"
_DATE = r"^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[.-][0-9]{2}[.-][0-9]{4})"
_CLOCK = r"^[0-9]{2}(?::[0-9]{2}){2,3}$"
# Trees: at most so many candidates to learn from, of every kind, chosen by hash of their documents.
SAMPLE_CANDIDATES = 20_000
ROUNDS, DEPTH = 8, 3
# Calibration: the share of true ones among those accepted, and how many seeds of its own kind weigh as much as all kinds'.
PRECISION, POOLED = 0.99, 20
# Texts whose hash leaves this part are kept from the fit, to calibrate on.
FOLDS = 3
# Length of the chunks in which arrays are summed up.
CHUNK = 256

_SPAN = "struct<start:int,end:int,value:string,before:string>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is made once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For every place of an array of int what ``combine`` makes of 0 and all values before it.

    Chunks are combined first, so an array of n values costs n * CHUNK + (n / CHUNK)^2 steps, not n^2.
    """
    zero = F.lit(0)

    def appended(state: Column, value: Column) -> Column:
        return F.concat(state, F.array(combine(F.element_at(state, -1), value)))

    def of(values: Column) -> Column:
        n_chunks = F.ceil(F.size(values) / F.lit(CHUNK)).cast("int")
        numbers = F.filter(F.sequence(F.lit(0), n_chunks), lambda c: c < n_chunks)
        chunks = F.transform(numbers, lambda c: F.slice(values, c * CHUNK + 1, CHUNK))

        def within(chunks: Column) -> Column:
            totals = F.transform(chunks, lambda chunk: F.aggregate(chunk, zero, combine))

            def made(befores: Column) -> Column:
                return F.flatten(
                    F.transform(
                        chunks,
                        lambda chunk, c: let(
                            F.aggregate(chunk, F.array(F.get(befores, c)), appended),
                            lambda sums: F.slice(sums, F.lit(1), F.size(sums) - 1),
                        ),
                    )
                )

            return let(F.aggregate(totals, F.array(zero), appended), made)

        return let(chunks, within)

    return let(values, of)


def located(text: Column, pattern: str) -> Column:
    """The matches of a pattern from left to right, as array of (start, end, value, before) in code points.

    Each match is set between marks, the text cut at the marks and the lengths of the pieces added up.
    """
    mark = "\x01"
    cut = F.split(F.regexp_replace(F.translate(text, mark, "\x02"), pattern, f"{mark}$0{mark}"), mark, -1)

    def of(pieces: Column) -> Column:
        def placed(starts: Column) -> Column:
            # Every second piece is a match.
            numbers = F.filter(F.sequence(F.lit(0), F.size(pieces)), lambda n: (n % 2 == 1) & (n < F.size(pieces)))
            return F.transform(
                numbers,
                lambda n: F.struct(
                    F.get(starts, n).alias("start"),
                    (F.get(starts, n) + F.length(F.get(pieces, n))).alias("end"),
                    F.get(pieces, n).alias("value"),
                    F.right(F.get(pieces, n - 1), F.lit(24)).alias("before"),
                ),
            )

        return let(running(F.transform(pieces, F.length), add), placed)

    return let(cut, of)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a number of at most 19 digits has a right check digit."""

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - place, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(place % 2 == 1, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(digit)

    places = F.sequence(F.lit(0), F.greatest(F.length(digits), F.lit(1)) - 1)
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    """The check of a base kind."""
    digits = _digits(value)
    if kind == "ip":
        part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _none() -> Column:
    return F.expr(f"CAST(array() AS array<{_SPAN}>)")


def base_spans(text: Column, kind: str) -> Column:
    """What a base rule finds: the matches of its pattern that pass its check."""
    worth = text.contains(_HOLDS[kind]) & (F.lit(True) if kind == "email" else text.rlike("[0-9]"))
    return F.when(worth, F.filter(located(text, BASE_PATTERNS[kind]), lambda m: _passes(kind, m["value"]))).otherwise(_none())


def _worth(text: Column, holds: tuple[str, ...]) -> Column:
    return reduce(and_, (text.rlike(pattern) for pattern in holds))


def _named(kind: str) -> Callable[[Column], Column]:
    """A span as (kind, start, end, value, before)."""
    return lambda m: F.struct(F.lit(kind).alias("kind"), *(m[c].alias(c) for c in ("start", "end", "value", "before")))


def candidates(text: Column) -> Column:
    """What the generators propose: array of (kind, start, end, value, before), in order and without repeats."""
    found = [
        F.transform(F.when(_worth(text, holds), located(text, pattern)).otherwise(_none()), _named(kind))
        for (kind, pattern), holds in zip(GENERATORS, _GENERATOR_HOLDS, strict=True)
    ]

    def new(spans: Column) -> Column:
        def first(span: Column, n: Column) -> Column:
            before = F.get(spans, n - 1)
            return (n == 0) | (span["kind"] != before["kind"]) | (span["start"] != before["start"]) | (span["end"] != before["end"])

        return F.filter(spans, first)

    return let(F.array_sort(F.concat(*found)), new)


def touched(spans: Column, others: Column) -> Column:
    """``spans`` as (meets, span): whether a span has a place in common with any of ``others``; in any order.

    Both go into one array: spans by their end, others by their start and after them. A span meets one of the
    others if one that starts before the span's end reaches beyond the span's start.
    """
    asked = F.transform(spans, lambda s: F.struct(s["end"].alias("at"), F.lit(0).alias("reach"), s.alias("span")))
    nothing = F.when(F.lit(False), F.get(spans, F.lit(0)))
    given = F.transform(others, lambda o: F.struct(o["start"].alias("at"), o["end"].alias("reach"), nothing.alias("span")))

    def of(events: Column) -> Column:
        def judged(reached: Column) -> Column:
            marked = F.transform(
                events, lambda e, n: F.struct((F.get(reached, n) > e["span"]["start"]).alias("meets"), e["span"].alias("span"))
            )
            return F.filter(marked, lambda m: m["span"].isNotNull())

        return let(running(F.transform(events, lambda e: e["reach"]), lambda a, b: F.greatest(a, b)), judged)

    return let(F.array_sort(F.concat(asked, given)), of)


def seeds(text: Column) -> Column:
    """Candidates that are surely true or false, as array of (label, span)."""
    base = F.concat(*(F.transform(base_spans(text, kind), _named(kind)) for kind in BASE_KINDS))

    def of(base: Column) -> Column:
        # Base spans and candidates in one order: a candidate that a base rule of its kind confirms stands right after it.
        def ranked(proposed: int) -> Callable[[Column], Column]:
            names = ("kind", "start", "end", None, "value", "before")
            return lambda m: F.struct(*(m[c].alias(c) if c else F.lit(proposed).alias("proposed") for c in names))

        both = F.concat(F.transform(base, ranked(0)), F.transform(candidates(text), ranked(1)))

        def compared(ordered: Column) -> Column:
            def confirmed(e: Column, n: Column) -> Column:
                before = F.get(ordered, n - 1)
                same = reduce(and_, (before[c] == e[c] for c in ("kind", "start", "end")))
                return (n > 0) & (before["proposed"] == 0) & same

            names = ("kind", "start", "end", "value", "before", "proposed")
            marked = F.transform(
                ordered, lambda e, n: F.struct(*(e[c].alias(c) for c in names), confirmed(e, n).alias("confirmed"))
            )
            return F.filter(marked, lambda m: m["proposed"] == 1)

        met = touched(let(F.array_sort(both), compared), base)
        labelled = F.transform(met, lambda m: F.struct(_seed(m["span"], m["meets"]).alias("label"), m["span"].alias("c")))
        return F.filter(labelled, lambda m: m["label"].isNotNull())

    return let(base, of)


def features(c: Column) -> dict[str, Column]:
    """Format and context of a candidate, as numbers."""
    value, before = c["value"], c["before"]

    def count(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)).cast("double")

    return {
        "kind": F.array_position(F.array(*map(F.lit, KINDS)), c["kind"]).cast("double"),
        "n_chars": F.length(value).cast("double"),
        "n_digits": count("[0-9]"),
        "n_upper": count("[A-Z]"),
        "n_lower": count("[a-z]"),
        "n_groups": count("[0-9]+"),
        "n_changes": count("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])"),
        "n_separators": count(r"[\s().-]"),
        "has_at": count("@"),
        "has_assignment": count("[=:]"),
        "distinct": F.size(F.array_distinct(F.split(value, ""))).cast("double"),
        "after_key_word": before.rlike(_KEY_WORDS).cast("double"),
        "after_mark": before.rlike(r"[=:\"'+]\s*$").cast("double"),
    }


def _seed(c: Column, meets: Column) -> Column:
    """1.0 for a candidate that is surely true, 0.0 for one surely false, null for the others.

    ``meets`` says whether a base span shares a place with it; unless that one confirms it, the candidate is false:
    what stands there is known to be something else.
    """
    value, digits = c["value"], _digits(c["value"])
    n = F.length(digits)
    named = value.rlike(_ANCHORED)
    address = F.regexp_count(value, F.lit(":"))
    wrong = (
        F.when(c["kind"] == "card", n.between(16, 19) & ~_passes("card", value))
        .when(c["kind"] == "ip", F.when(value.contains(":"), value.rlike(_CLOCK)).otherwise(~_passes("ip", value)))
        .when(c["kind"] == "phone", ~n.between(8, 15) | value.rlike(_DATE))
        .when(c["kind"] == "email", ~value.rlike("[A-Za-z]{2,}$"))
        .otherwise(F.when(named, value.rlike(_PLACEHOLDER)).otherwise(value.rlike("^[0-9]+$|^[A-Z]+$") | c["before"].rlike(_CODE)))
    )
    right = ((c["kind"] == "secret") & named) | ((c["kind"] == "ip") & (address == 7))
    return F.when(c["confirmed"], 1.0).when(wrong | meets, 0.0).when(right, 1.0)


def _node(node, names: list[str]) -> Callable[[Mapping[str, Column]], Column]:
    """A tree of the fitted model as a column expression over features."""
    if node.subtreeDepth() == 0:
        value = node.prediction()
        return lambda x: F.lit(value)
    name, threshold = names[node.split().featureIndex()], node.split().threshold()
    left, right = _node(node.leftChild(), names), _node(node.rightChild(), names)
    return lambda x: F.when(x[name] <= threshold, left(x)).otherwise(right(x))


def _shares(counts: Mapping[str, int]) -> dict[str, float]:
    """Per kind the share of its seeds to learn from: as many of each as there are, within ``SAMPLE_CANDIDATES`` in all."""
    shares, left = {}, SAMPLE_CANDIDATES
    for at, (kind, n) in enumerate(sorted(counts.items(), key=lambda found: found[1])):
        taken = min(n, left // (len(counts) - at))
        shares[kind], left = taken / n, left - taken
    return shares


def _thresholds(bins: Mapping[tuple[str, int], tuple[float, int]]) -> dict[str, float]:
    """Per kind the lowest score from which on nearly all are true, from (true, all) by kind and score in hundredths.

    The share of true ones of all kinds counts as ``POOLED`` more seeds of a kind, so a kind without seeds has the
    threshold of all kinds, and one with many its own.
    """
    own, pooled, thresholds = {kind: (0.0, 0) for kind in KINDS}, (0.0, 0), {}
    for at in sorted({at for _, at in bins}, reverse=True):
        for kind in KINDS:
            true, n = bins.get((kind, at), (0.0, 0))
            own[kind] = (own[kind][0] + true, own[kind][1] + n)
            pooled = (pooled[0] + true, pooled[1] + n)
        for kind, (true, n) in own.items():
            if true + POOLED * pooled[0] / pooled[1] >= PRECISION * (n + POOLED):
                thresholds[kind] = at / 100
    return thresholds


def fit_candidates(docs: DataFrame) -> Callable[[Column], Column] | None:
    """A predicate on candidates that says which to accept, learnt from ``docs``; None if nothing can be learnt."""
    # Copies of a text fall in one part, whatever their doc_id, so none is fitted on and calibrated on.
    own = docs.select(text_of().alias("text")).withColumn("_hash", F.pmod(F.xxhash64("text"), F.lit(1 << 30)))
    likely = own.filter(reduce(or_, (_worth(F.col("text"), holds) for holds in _GENERATOR_HOLDS)))
    labelled = likely.select("_hash", F.explode(seeds(F.col("text"))).alias("s"))
    numbers = {f"f_{name}": value for name, value in features(F.col("s.c")).items()}
    found = stored(labelled.select("s.label", "_hash", "s.c.kind", *(v.alias(n) for n, v in numbers.items())), "candidate-seeds")
    learnt = found.filter(F.col("_hash") % FOLDS != 0)
    shares = _shares({r.kind: r.n for r in learnt.groupBy("kind").agg(F.count("*").alias("n")).collect()})
    least = F.lit(0)
    for kind, share in shares.items():
        least = F.when(F.col("kind") == kind, int(share * (1 << 30))).otherwise(least)
    # Ordered, so that every run learns from the same candidates, in the same order.
    chosen = learnt.filter(F.pmod(F.xxhash64("_hash", "kind"), F.lit(1 << 30)) < least)
    fitting = stored(
        chosen.orderBy("_hash", "kind", "label", *numbers).limit(SAMPLE_CANDIDATES).coalesce(1), "fitting-seeds"
    )
    if fitting.select("label").distinct().count() < 2:
        return None
    names = [n.removeprefix("f_") for n in numbers]
    assembler = VectorAssembler(inputCols=[f"f_{name}" for name in names], outputCol="features")
    trees = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, maxBins=64, minInstancesPerNode=10, seed=7, featuresCol="features", labelCol="label")
    model = trees.fit(assembler.transform(fitting))
    nodes = [_node(tree._java_obj.rootNode(), names) for tree in model.trees]

    def score(x: Mapping[str, Column]) -> Column:
        margin = sum((F.lit(w) * node(x) for w, node in zip(model.treeWeights, nodes, strict=True)), F.lit(0.0))
        return 1 / (1 + F.exp(-2 * margin))

    # Per kind the numbers of seeds by score in hundredths, of texts not fitted on.
    held = found.filter(F.col("_hash") % FOLDS == 0)
    scored = held.select("kind", "label", F.floor(score({n: F.col(f"f_{n}") for n in names}) * 100).alias("bin"))
    bins = scored.groupBy("kind", "bin").agg(F.sum("label").alias("true"), F.count("*").alias("n")).collect()
    thresholds = _thresholds({(r.kind, r.bin): (r.true, r.n) for r in bins})
    if not thresholds:
        return None

    def accepted(c: Column) -> Column:
        least = F.lit(2.0)
        for kind, value in thresholds.items():
            least = F.when(c["kind"] == kind, value).otherwise(least)
        return score(features(c)) >= least

    return accepted


def _numbered(kind: int, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def personal_data(docs: DataFrame, kept: list[str] | None = None) -> DataFrame:
    """_doc (columns ``kept`` of ``docs``, doc_id by default), _whole (the text), and _base and _spans, arrays of
    (kind, start, end) in listed order.

    kind is the place in ``KINDS``; _spans holds _base and the spans that the trees add, which touch no base span.
    """
    accepted = fit_candidates(docs)
    kept = ["doc_id"] if kept is None else kept
    # The caller's columns go into one, so that none can be taken for a helper.
    rows = docs.select(F.struct(*(F.col(f"`{name}`") for name in kept)).alias("_doc"), text_of().alias("_whole"))
    text = F.col("_whole")
    base = F.concat(*(_numbered(n, base_spans(text, kind)) for n, kind in enumerate(BASE_KINDS)))

    def listed(base: Column) -> Column:
        if accepted is None:
            return F.struct(base.alias("base"), base.alias("spans"))
        free = F.filter(touched(F.filter(candidates(text), accepted), base), lambda m: ~m["meets"])
        more = F.transform(
            free,
            lambda m: F.struct(
                (F.array_position(F.array(*map(F.lit, KINDS)), m["span"]["kind"]) - 1).cast("int").alias("kind"),
                m["span"]["start"].alias("start"),
                m["span"]["end"].alias("end"),
            ),
        )
        return F.struct(base.alias("base"), F.array_sort(F.concat(base, more)).alias("spans"))

    found = rows.select("_doc", "_whole", let(F.array_sort(base), listed).alias("_found"))
    return found.select("_doc", "_whole", F.col("_found.base").alias("_base"), F.col("_found.spans").alias("_spans"))


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def _equals(value: int) -> Callable[[Column], Column]:
    return lambda x: x == value


def personal_data_report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Counts and base_sha256 are of the base rules, spans lists all spans as kind:start:end, in code points,
    end exclusive.

    Null texts are empty and have no spans; texts of any length are read whole. Null doc_ids stay null; repeated
    rows are read each; an empty table gives no rows; without seeds of both kinds the trees add nothing. Other columns are not looked at.
    """
    found = personal_data(docs)
    counts = [
        F.size(F.filter(F.col("_base")["kind"], _equals(n))).cast("bigint").alias(f"n_{kind}")
        for n, kind in enumerate(BASE_KINDS)
    ]
    return found.select(
        "_doc.doc_id", *counts, F.sha2(_written(F.col("_base")), 256).alias("base_sha256"), _written(F.col("_spans")).alias("spans")
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of its texts replaced by its kind in brackets; other texts are left as they are.

    Spans that overlap are replaced from the first start to the last end, with a mark for each that reaches beyond those
    before it. Null and empty texts stay, texts of any length are read whole, repeated rows are treated alike, an
    empty table stays empty. All columns are kept as they are, whatever their names.
    """
    found = personal_data(docs, docs.columns)
    by_place = F.array_sort(
        F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    marks = F.array(*(F.lit(f"[{kind.upper()}]") for kind in KINDS))
    whole = F.col("_whole")

    def of(spans: Column) -> Column:
        def cut(reached: Column) -> Column:
            def chunk(first: Column) -> Column:
                # A chunk's spans are cut from its own part of the text, which begins where those before it have reached.
                since, last = F.get(reached, first), F.least(first + CHUNK, F.size(spans)) - 1
                until = F.greatest(F.get(reached, last), F.get(spans, last)["end"])

                def replaced(part: Column) -> Column:
                    def one(s: Column, n: Column) -> Column:
                        before = F.get(reached, first + n)
                        own = F.when(s["end"] > before, F.get(marks, s["kind"])).otherwise("")
                        between = F.substring(part, before - since + 1, F.greatest(s["start"] - before, F.lit(0)))
                        return F.concat(between, own)

                    return F.array_join(F.transform(F.slice(spans, first + 1, CHUNK), one), "")

                return let(F.substring(whole, since + 1, until - since), replaced)

            firsts = F.filter(F.sequence(F.lit(0), F.size(spans), F.lit(CHUNK)), lambda first: first < F.size(spans))
            end = F.greatest(F.element_at(reached, -1), F.element_at(spans, -1)["end"])
            return F.concat(F.array_join(F.transform(firsts, chunk), ""), F.substring(whole, end + 1, F.length(whole)))

        ends = F.transform(spans, lambda s: s["end"])
        return let(running(ends, lambda a, b: F.greatest(a, b)), cut)

    done = F.when(F.size("_spans") > 0, let(by_place, of)).otherwise(F.col("_doc.text"))
    named = [done.alias(name) if name == "text" else F.col(f"_doc.`{name}`") for name in docs.columns]
    return found.select(*named)
