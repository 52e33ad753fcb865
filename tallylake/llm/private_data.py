"""Personal data: candidate spans, gradient boosting over their format and context, thresholds.

The base patterns find well-formed e-mail, IP, card and phone numbers; their valid
matches are always reported. Looser generators propose more spans, such as obfuscated addresses or cards
with other separators. A proposal has to pass the same check as a base match (check digit, ranges,
number of digits) once it is written plainly. What the check can't tell, whether such a number is
personal data where it stands, boosted trees learn from the texts: from the base matches on one
side, and on the other from look-alikes of every kind that fail the check, such as versions, dates and order
numbers. The trees see context and separators only, nothing that the checks look at. A threshold per
kind, calibrated on the half of the documents that the trees did not see, selects the proposals that are
added; a kind without look-alikes or without enough evidence adds none.

Everything on the way is DataFrame functions. Patterns are written so that they scan a text once:
possessive, and starting only where a run of their characters starts. Places, overlaps and redacted texts
come from running sums and maxima in blocks, so a text of very many matches costs little more than its length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.llm import boosting
from tallylake.llm.tables import written

KINDS = ("email", "ip", "card", "phone")
MIN_PRECISION = 0.99  # of a kind's threshold, on documents the trees did not see
MIN_EVIDENCE = 20  # calibration rows above a threshold, and look-alikes of a kind; with fewer, nothing is added

_RUN = r"(?:\G|(?<![A-Za-z0-9._%+-]))"
BASE = {
    "email": _RUN + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    # a written-out "at" counts only with a written-out "dot", and a bare point only inside a word
    "email": (
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++"
        r"(?:(?:\s?@\s?|\s?[\[({]\s?(?:at|AT|@)\s?[\])}]\s?)[A-Za-z0-9-]++"
        r"(?:(?:\.|\s?[\[({]\s?(?:dot|DOT|\.)\s?[\])}]\s?|\s(?:dot|DOT)\s)[A-Za-z0-9-]{2,}+){1,4}+"
        r"|\s(?:at|AT)\s[A-Za-z0-9-]++(?:\s(?:dot|DOT)\s[A-Za-z0-9-]{2,}+){1,4}+)"
    ),
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:(?:\s?[\[(]\s?(?:\.|dot)\s?[\])]\s?|\s?\.\s?)[0-9]{1,3}+){3}+(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}+(?:[\x20._/ -]{0,2}+[0-9]{4}+){2,3}+(?:[\x20._/ -]{0,2}+[0-9]{1,3}+)?+(?![0-9])",
    "phone": (
        r"(?<![0-9A-Za-z.+])(?:00[1-9][0-9]{0,2}+[\x20./-]{1,2}+)?+\(?+[0-9]{2,4}+\)?+[\x20./-]{1,2}+"
        r"[0-9]{3,4}+[\x20./-]{1,2}+[0-9]{3,4}+(?![0-9])"
    ),
}
# What a kind is mistaken for; matches that pass the kind's check are no look-alikes.
LOOK_ALIKES = {
    "email": r"(?<![A-Za-z0-9._%+@-])[A-Za-z0-9._%+-]*+@[A-Za-z0-9-]*+(?![A-Za-z0-9.@-])",
    "ip": r"(?<![0-9.])[0-9]++(?:\.[0-9]++){1,2}+(?![0-9.])",
    "phone": r"(?<![0-9A-Za-z.+/-])[0-9]{1,4}+(?:[\x20./-][0-9]{1,4}+){1,2}+(?![0-9])",
}
# No pattern matches a text without one of these.
ANY = r"[0-9@]|[\[({]\s?(?:at|AT)\s?[\])}]|\s(?:dot|DOT)\s"
CUES = {
    "email": r"(?i)(e-?mail|mail|contact|write|reach|address)\W*$",
    "ip": r"(?i)(ip|host|server|address|addr|from|client|login)\W*$",
    "card": r"(?i)(card|visa|credit|debit|payment|pay|account|number)\W*$",
    "phone": r"(?i)(phone|tel|telephone|call|mobile|cell|fax|dial)\W*$",
}
CONTEXT = 24  # characters before a span that its features see
FEATURES = ("kind", "separators", "before", "after", "cue", "marked")
STEP = 64  # values that a running sum or maximum goes over one by one
PIECE = 4_096  # code points of the pieces that a text is redacted by


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


def _none() -> Column:
    return F.array().cast("array<struct<start:int,stop:int,value:string,before:string,after:string>>")


def running(values: Column, combine, start: Column, levels: int = 2) -> Column:
    """For each value the combination of all values before it, and ``start`` for the first.

    Runs of ``STEP`` values are combined first, and the same is done to what they give, so a value
    costs ``STEP`` steps a level and not as many steps as there are values before it.
    """

    def up_to(all_: Column, low: Column, count: Column, first: Column) -> Column:
        return F.aggregate(F.slice(all_, low + 1, count), first, combine)

    def of(all_: Column) -> Column:
        if not levels:
            return F.transform(all_, lambda _, k: up_to(all_, F.lit(0), k, start))
        runs = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / F.lit(STEP)).cast("int")),
            lambda j: up_to(all_, j * STEP, F.lit(STEP), start),
        )
        before = running(runs, combine, start, levels - 1)
        return _bound(
            before,
            lambda first: F.transform(
                all_,
                lambda _, k: up_to(
                    all_, k - k % STEP, k % STEP, F.get(first, F.floor(k / F.lit(STEP)).cast("int"))
                ),
            ),
        )

    return _bound(values, lambda all_: F.when(F.size(all_) == 0, all_).otherwise(of(all_)))


def found(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with their places in code points and what is around them.

    A split by the pattern gives the texts between the matches, whose lengths give the places.
    """

    def place(pair: Column) -> Column:
        values, gaps = pair["values"], pair["gaps"]
        lengths = F.zip_with(
            F.transform(values, lambda v: F.length(v)),
            F.slice(F.transform(gaps, lambda g: F.length(g)), 1, F.size(values)),
            lambda v, g: v + g,
        )

        def one(passed: Column) -> Column:
            def span(value: Column, k: Column) -> Column:
                gap = F.get(gaps, k)
                start = F.get(passed, k) + F.length(gap)
                return F.struct(
                    start.alias("start"),
                    (start + F.length(value)).alias("stop"),
                    value.alias("value"),
                    F.right(gap, F.lit(CONTEXT)).alias("before"),
                    F.left(F.get(gaps, k + 1), F.lit(1)).alias("after"),
                )

            return F.transform(values, span)

        return _bound(running(lengths, lambda a, x: a + x, F.lit(0)), one)

    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return _bound(
        values,
        lambda v: F.when(F.size(v) == 0, _none()).otherwise(
            _bound(F.struct(v.alias("values"), F.split(text, pattern).alias("gaps")), place)
        ),
    )


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a non-empty digit text is right."""

    def share(k: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - k, F.lit(1)).cast("int")
        return F.when(k % 2 == 0, digit).otherwise(F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit))

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(F.transform(places, share), F.lit(0), lambda a, x: a + x) % 10 == 0


def octets(value: Column) -> Column:
    """Whether the numbers in a text are four of at most 255 each."""
    numbers = F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0))
    small = F.forall(numbers, lambda n: F.regexp_replace(n, "^0+", "").rlike("^([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    return (F.size(numbers) == 4) & small


def valid(kind: str, value: Column) -> Column:
    """The check of a base match."""
    n = F.length(digits_of(value))
    if kind == "ip":
        return octets(value)
    if kind == "card":
        return F.when(n.between(12, 19), luhn(digits_of(value))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def plain(kind: str, value: Column) -> Column:
    """A proposal as the base pattern would want it written."""
    if kind != "email":
        return value
    at = F.regexp_replace(value, r"\s?[\[({]\s?(?:at|AT|@)\s?[\])}]\s?|\s(?:at|AT)\s|\s?@\s?", "@")
    return F.regexp_replace(at, r"\s?[\[({]\s?(?:dot|DOT|\.)\s?[\])}]\s?|\s(?:dot|DOT)\s", ".")


def proposable(kind: str, value: Column) -> Column:
    """The same check for a proposal; an address has to end like a domain."""
    if kind == "email":
        return plain(kind, value).rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$")
    return valid(kind, value)


def _edge(character: Column) -> Column:
    """0: text border or space, 1: punctuation, 2: letter or digit."""
    return F.when(character.rlike(r"^[\p{L}\p{N}]$"), 2).when(character.rlike(r"^\S$"), 1).otherwise(0)


def described(kind: str, span: Column) -> Column:
    """A span with the small integer features of its context and separators."""
    separators = F.regexp_replace(span["value"], "[A-Za-z0-9]+", "")
    return F.struct(
        span["start"].alias("start"),
        span["stop"].alias("stop"),
        F.lit(KINDS.index(kind)).alias("kind"),
        F.when(separators == "", 0)
        .when(separators.rlike(r"^[\x20-]+$"), 1)
        .when(separators.rlike(r"^[@._%+-]+$"), 2)
        .otherwise(3)
        .alias("separators"),
        _edge(F.right(span["before"], F.lit(1))).alias("before"),
        _edge(span["after"]).alias("after"),
        span["before"].rlike(CUES[kind]).cast("int").alias("cue"),
        F.when(span["before"].rlike(r"[:=#]\s*$"), 2)
        .when(span["before"].rlike(r"""["'(<\[]$"""), 1)
        .otherwise(0)
        .alias("marked"),
    )


def free_of(others: Column, base: Column) -> Column:
    """The spans of ``others`` that no span of ``base`` overlaps.

    Sorted by start, with base spans first among equals, a span is overlapped if a base span before it
    ends after its start, or the next base span starts before its end.
    """
    far = F.lit(2**31 - 1)

    def as_item(role: int):
        return lambda span: F.struct(span["start"].alias("start"), F.lit(role).alias("role"), span.alias("span"))

    def sweep(items: Column) -> Column:
        stops = F.transform(items, lambda x: F.when(x["role"] == 0, x["span"]["stop"]).otherwise(0))
        starts = F.transform(F.reverse(items), lambda x: F.when(x["role"] == 0, x["start"]).otherwise(far))
        both = F.struct(
            running(stops, lambda a, x: F.greatest(a, x), F.lit(0)).alias("ended"),
            F.reverse(running(starts, lambda a, x: F.least(a, x), far)).alias("next"),
        )

        def pick(b: Column) -> Column:
            marked = F.transform(
                items,
                lambda x, k: F.when(
                    (x["role"] == 1)
                    & (F.get(b["ended"], k) <= x["start"])
                    & (F.get(b["next"], k) >= x["span"]["stop"]),
                    x["span"],
                ),
            )
            return F.filter(marked, lambda x: x.isNotNull())

        return _bound(both, pick)

    items = F.sort_array(F.concat(F.transform(base, as_item(0)), F.transform(others, as_item(1))))
    return F.when((F.size(base) == 0) | (F.size(others) == 0), others).otherwise(_bound(items, sweep))


def candidates(text: Column) -> Column:
    """Struct of ``base`` (valid base spans), ``failed`` (look-alikes) and ``proposed``.

    Look-alikes and proposals that overlap a valid base span of any kind are left out.
    """

    def split(matches: Column) -> Column:
        base, failed, proposed = [], [], []
        for kind in KINDS:
            base.append(F.transform(F.filter(matches[kind], _passes(valid, kind)), _describe(kind)))
            failed.append(F.transform(F.filter(matches[kind], _fails(valid, kind)), _describe(kind)))
            if kind in LOOK_ALIKES:
                alike = F.filter(matches[f"like_{kind}"], _fails(proposable, kind))
                failed.append(F.transform(alike, _describe(kind)))
            more = F.filter(matches[f"more_{kind}"], _passes(proposable, kind))
            proposed.append(F.transform(more, _describe(kind)))
        return F.struct(
            F.concat(*base).alias("base"),
            F.concat(*failed).alias("failed"),
            F.concat(*proposed).alias("proposed"),
        )

    def prune(s: Column) -> Column:
        return F.struct(
            s["base"].alias("base"),
            free_of(s["failed"], s["base"]).alias("failed"),
            free_of(s["proposed"], s["base"]).alias("proposed"),
        )

    has_any = F.coalesce(text, F.lit("")).rlike(ANY)
    content = F.when(has_any, text).otherwise("")
    matches = F.struct(
        *[found(content, BASE[k]).alias(k) for k in KINDS],
        *[found(content, GENERATORS[k]).alias(f"more_{k}") for k in KINDS],
        *[found(content, pattern).alias(f"like_{k}") for k, pattern in LOOK_ALIKES.items()],
    )
    return _bound(matches, lambda m: _bound(split(m), prune))


def _passes(check, kind: str):
    return lambda span: check(kind, span["value"])


def _fails(check, kind: str):
    return lambda span: ~check(kind, span["value"])


def _describe(kind: str):
    return lambda span: described(kind, span)


@dataclass(frozen=True)
class Detector:
    """The trees and the score from which proposals of each kind are added; above 1 adds none."""

    trees: boosting.Boosted
    thresholds: tuple[float, ...]

    def accepts(self, span: Column) -> Column:
        least = F.element_at(F.array(*[F.lit(t) for t in self.thresholds]), span["kind"] + 1)
        return self.trees.column({name: span[name] for name in FEATURES}) >= least


def train(found_spans: DataFrame, half: Column) -> Detector:
    """Fit to the base matches and look-alikes of one half of the documents and calibrate on the other.

    Both halves come as counts per combination of features, of which there are at most a few thousand.
    Look-alikes of the calibration half that score below a threshold are what shows that it
    tells the two apart, so each kind needs ``MIN_EVIDENCE`` of them too.
    """
    labelled = F.concat(
        F.transform("spans.base", lambda s: F.struct(s.alias("s"), F.lit(1).alias("y"))),
        F.transform("spans.failed", lambda s: F.struct(s.alias("s"), F.lit(0).alias("y"))),
    )
    rows = found_spans.select(half.alias("half"), F.explode(labelled).alias("row"))
    counts = rows.groupBy("half", *[F.col(f"row.s.{name}").alias(name) for name in FEATURES]).agg(
        F.sum("row.y").alias("positive"), F.sum(1 - F.col("row.y")).alias("negative")
    )
    table: dict[bool, list] = {True: [], False: []}
    for row in counts.orderBy("half", *FEATURES).collect():
        features = {name: int(row[name]) for name in FEATURES}
        table[bool(row["half"])].append((features, float(row["positive"]), float(row["negative"])))
    trees = boosting.fit(table[True], FEATURES)
    return Detector(trees, tuple(_threshold(trees, table[False], kind) for kind in range(len(KINDS))))


def _threshold(trees: boosting.Boosted, table: list, kind: int) -> float:
    """The lowest score from which on ``MIN_PRECISION`` of a kind's rows are base matches; else above 1."""
    scored = [(trees.of(f), p, n) for f, p, n in table if f["kind"] == kind]
    best = 2.0
    for least in sorted({s for s, _, _ in scored}, reverse=True):
        right = sum(p for s, p, _ in scored if s >= least)
        wrong = sum(n for s, _, n in scored if s >= least)
        refused = sum(n for s, _, n in scored if s < least)
        enough = right + wrong >= MIN_EVIDENCE and refused >= MIN_EVIDENCE
        if enough and right >= MIN_PRECISION * (right + wrong):
            best = max(least, 0.5)
    return best


def _listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("a"), s["kind"].alias("k"), s["stop"].alias("z")))
    )
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(names, s["k"] + 1), s["a"], s["z"])), ","
    )


def detected(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every whole text.

    The counts and the digest are of the valid base matches, ``spans`` adds the accepted
    proposals. Places are in code points, the end exclusive. NULL and empty texts have no spans.
    Rows are independent, so repeated rows agree; NULL ids train in the half of the empty text; other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), candidates(F.col(text)).alias("spans"))
    rows = written(rows, "private-spans")
    detector = train(rows, half_of(F.col("doc_id")))
    rows = rows.withColumn("added", F.filter("spans.proposed", detector.accepts))
    base = F.col("spans.base")
    return rows.select(
        "doc_id",
        *[
            F.size(F.filter(base, _of_kind(k))).cast("long").alias(f"n_{name}")
            for k, name in enumerate(KINDS)
        ],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.concat(base, F.col("added"))).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def _of_kind(k: int):
    return lambda span: span["kind"] == k


def half_of(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 2 == 0


def replaced(content: Column, spans: Column) -> Column:
    """A text with its spans given way to their kinds; where spans overlap, the first one's mark stands for all."""
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def between(pieces: Column, low: Column, high: Column) -> Column:
        """Code points ``low`` to ``high``, cut out of pieces of ``PIECE`` code points."""
        first, last = (F.floor(x / F.lit(PIECE)).cast("int") for x in (low, high))
        head, tail = F.get(pieces, first), F.coalesce(F.get(pieces, last), F.lit(""))
        return F.when(
            first == last, F.coalesce(F.substring(head, low % PIECE + 1, high - low), F.lit(""))
        ).otherwise(
            F.concat(
                F.substring(head, low % PIECE + 1, F.lit(PIECE)),
                F.array_join(F.slice(pieces, first + 2, last - first - 1), ""),
                F.substring(tail, F.lit(1), high % PIECE),
            )
        )

    def parts(s: Column) -> Column:
        ordered, upto, pieces = s["ordered"], s["upto"], s["pieces"]
        one = F.transform(
            ordered,
            lambda x, k: F.when(
                F.get(upto, k) <= x["a"],
                F.concat(between(pieces, F.get(upto, k), x["a"]), F.element_at(marks, x["k"] + 1)),
            ).otherwise(""),
        )
        end = F.array_max(F.transform(ordered, lambda x: x["z"]))
        rest = between(pieces, end, F.length(content))
        return F.concat(F.array_join(one, ""), rest)

    def prepare(ordered: Column) -> Column:
        stops = F.transform(ordered, lambda x: x["z"])
        return F.struct(
            ordered.alias("ordered"),
            running(stops, lambda a, x: F.greatest(a, x), F.lit(0)).alias("upto"),
            F.regexp_extract_all(content, F.lit("(?s).{1,%d}" % PIECE), F.lit(0)).alias("pieces"),
        )

    places = F.array_sort(
        F.transform(
            spans, lambda s: F.struct(s["start"].alias("a"), s["kind"].alias("k"), s["stop"].alias("z"))
        )
    )
    return _bound(
        places,
        lambda p: F.when(F.size(p) == 0, content).otherwise(_bound(prepare(p), parts)),
    )


def redacted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every reported span replaced by its kind, as ``[EMAIL]``; same columns.

    Where spans overlap, the text up to the end of the last becomes the first one's mark.
    """
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.withColumn("spans", candidates(F.col(f"row.`{text}`")))
    # two passes over the texts, which is less than writing them out once more
    detector = train(rows, half_of(F.col(f"row.`{doc_id}`")))
    content = F.col(f"row.`{text}`")
    spans = F.concat(F.col("spans.base"), F.filter("spans.proposed", detector.accepts))
    clean = replaced(content, spans)
    return rows.select(
        *[clean.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    )
