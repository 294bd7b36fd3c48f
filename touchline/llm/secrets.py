"""Secret scans (operator 3). DataFrame functions only.

Fixed rules find assignments, access keys and hex strings. Two character
Markov models (pair statistics of random strings and of ordinary identifiers,
smoothed by single characters) find further strings: a run of ``min_chars`` or more of
``[A-Za-z0-9+/_=-]`` whose log-likelihood ratio per character pair is at least
``threshold`` becomes a span of kind ``markov``, unless it overlaps a span of a
rule; of any other run, the stretches of ``min_chars`` or more that reach it become
spans (:func:`stretches`: a random string joined to a name or a path). The models
are trained from labelled samples (text, random).

A text's spans come from its own row: the pieces between the matches give the
positions, so no row is shuffled. The models' table has a fixed size.

Cases: null text counts as empty; an empty text has no spans (empty string and
its digest); repeated rows are scanned alike, each on its own row; a null doc_id
is kept; without samples the ratio is 0 and no markov span is added; an empty
table gives no rows; other columns pass unchanged in :func:`redact` and are
ignored in the query.
"""
from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import clean_text, table

# Patterns, least lengths and order of the kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "markov")

#: Alphabet of the models; any other character counts as the last class.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
SIDE = len(ALPHABET) + 1
RUN = r"[A-Za-z0-9+/_=-]"
#: Weight of the single-character statistics in the pair statistics.
BACKOFF = 4.0
#: Ratio of a pair that ends in ``=``, ``/`` or ``-``, which join names and paths: about one of
#: 64 characters of a random string, and one of 8 of a path.
JOINT = math.log(8 / 64)
SPAN = "array<struct<start:int,end:int>>"


def found(text: Column, pattern: str, ok: Column | None = None) -> Column:
    """Spans of the pattern's leftmost matches that don't overlap. ``ok``: an
    array of booleans, one per match; the others are dropped."""
    sizes = F.arrays_zip(F.transform(F.split(text, pattern, -1), F.length).alias("before"),
                         F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length).alias("own"),
                         (ok if ok is not None else F.array().cast("array<boolean>")).alias("ok"))
    first = F.struct(F.lit(0).alias("pos"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + x["before"]
        end = start + F.coalesce(x["own"], F.lit(0))
        keep = x["own"].isNotNull() & F.coalesce(x["ok"], F.lit(ok is None))
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("pos"), F.when(keep, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    return F.when(text.rlike(pattern), F.aggregate(sizes, first, step)["out"]).otherwise(F.array().cast(SPAN))


def rule_spans(text: Column) -> dict[str, Column]:
    """Spans of the fixed rules by kind."""
    long_value = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= 8)
    long_key = F.transform(F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)), lambda v: F.length(v) >= 16)
    return {"assign": found(text, ASSIGN, long_value), "access": found(text, ACCESS, long_key), "hex": found(text, HEX)}


def char_class(c: Column) -> Column:
    """Place of a character in the alphabet, from 0."""
    at = F.instr(F.lit(ALPHABET), c)
    return F.when(at > 0, at - 1).otherwise(F.lit(SIDE - 1))


def pair_places(s: Column) -> Column:
    """The string's character pairs as numbers below SIDE * SIDE."""
    chars = F.transform(F.filter(F.split(s, ""), lambda c: c != ""), char_class)
    return F.zip_with(F.slice(chars, 1, F.greatest(F.size(chars) - 1, F.lit(0))), F.slice(chars, 2, F.greatest(F.size(chars), F.lit(1))),
                      lambda a, b: a * SIDE + b)


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio (random over ordinary) of each character pair, from
    ``samples`` (text string, random boolean): SIDE * SIDE numbers. What reaches
    the driver is the pair counts, at most two per pair of classes."""
    counts = [[0] * (SIDE * SIDE) for _ in range(2)]
    pairs = (samples.filter(F.col("text").isNotNull() & F.col("random").isNotNull())
             .select("random", F.explode(pair_places(F.col("text"))).alias("pair"))
             .groupBy("random", "pair").count())
    for r in pairs.collect():
        counts[int(r["random"])][r["pair"]] = r["count"]
    if not any(counts[0]) or not any(counts[1]):
        return [0.0] * (SIDE * SIDE)
    rows = [[sum(c[a * SIDE:(a + 1) * SIDE]) for a in range(SIDE)] for c in counts]
    ends = [[sum(c[b::SIDE]) for b in range(SIDE)] for c in counts]

    def logp(k: int, p: int) -> float:
        alone = (ends[k][p % SIDE] + 0.5) / (sum(ends[k]) + 0.5 * SIDE)
        return math.log((counts[k][p] + BACKOFF * alone) / (rows[k][p // SIDE] + BACKOFF))

    return [round(logp(1, p) - logp(0, p), 6) for p in range(SIDE * SIDE)]


def labelled_samples(docs: DataFrame, max_docs: int = 8192, text: str = "text") -> DataFrame:
    """Samples labelled by the rules, from at most ``max_docs`` documents that a
    rule may hit (those with the smallest hash of their text): the values of
    long matches are random strings, whole words of letters ordinary ones."""
    may = (docs.select(clean_text(text).alias("t"))
           .filter(F.col("t").rlike("(?i:password|passwd|secret|token|api_?key)|AKIA[A-Z0-9]{12}|" + HEX))
           .withColumn("h", F.xxhash64("t")))
    # the hashes alone are sorted; then only the texts up to the last one move
    last = may.select("h").distinct().orderBy("h").limit(max_docs).agg(F.max("h")).first()[0]
    hit = may.filter(F.col("h") <= F.lit(last)).groupBy("h").agg(F.min("t").alias("t"))
    t = F.col("t")
    values = F.concat(F.regexp_extract_all(t, F.lit(ACCESS), F.lit(0)), F.regexp_extract_all(t, F.lit(HEX), F.lit(0)),
                      F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)))
    words = F.regexp_extract_all(t, F.lit(f"(?<!{RUN})[A-Za-z_]{{4,}}(?!{RUN})"), F.lit(0))
    sample = lambda strings, random: F.transform(
        strings, lambda s: F.struct(s.alias("text"), F.lit(random).alias("random")))
    both = F.concat(sample(F.filter(values, lambda v: F.length(v) >= 16), True), sample(words, False))
    return hit.select(F.explode(both).alias("s")).select("s.text", "s.random")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def stretches(run: Column, ratios: Column, min_chars: int, threshold: float) -> Column:
    """Spans, by places in the run, of the strings that the models call random:
    a stretch of ``min_chars`` to twice as many characters qualifies if its mean
    ratio is at least ``threshold`` (a longer one that does holds such a one).
    Each moves to the ends near it that add most, then on to the next ``=`` or
    ``/``. Stretches that meet are one span. Worked in parts, so the cost is
    linear in the run. The samples hold no joined names, so a joint's ratio is fixed."""
    m = min_chars - 1
    joints = [ALPHABET.index(c) for c in "=/-"]
    over = F.transform(pair_places(run), lambda p: F.when((p % SIDE).isin(*joints), F.lit(JOINT)).when(F.floor(p / SIDE).isin(*joints), F.lit(0.0))
                       .otherwise(F.get(ratios, p.cast("int"))) - threshold)

    def windows(sums: Column, lo: Column, at: Column) -> Column:
        """From the sums up to each character of a part, which begins at ``lo``:
        the stretches that end in the part's core, from ``at`` on."""
        last = F.size(sums) - 1
        part = lambda i, j: F.slice(sums, F.greatest(i, F.lit(0)) + 1, F.greatest(F.least(j, last) - F.greatest(i, F.lit(0)) + 1, F.lit(0)))
        least = lambda j: part(j - 2 * m, j - m)

        def start(j: Column) -> Column:     # the last of equals
            near = least(j)
            return j - m - (F.array_position(F.reverse(near), F.array_min(near)).cast("int") - 1)

        def end(i: Column) -> Column:
            near = part(i + m, i + 2 * m)
            return i + m + F.array_position(near, F.array_max(near)).cast("int") - 1

        ends = F.filter(F.sequence(F.lit(0), last), lambda j: (j + lo >= at) & (j + lo < at + 4 * m) & (j >= m))
        good = F.filter(ends, lambda j: F.get(sums, j) >= F.array_min(least(j)))
        tops = F.array_distinct(F.transform(F.array_distinct(F.transform(good, start)), end))
        return F.transform(tops, lambda j: F.struct((start(j) + lo).alias("start"), (j + lo + 1).alias("end")))

    def core(scores: Column, at: Column) -> Column:
        lo = F.greatest(at - 3 * m, F.lit(0))
        part = F.slice(scores, lo + 1, at + 5 * m - lo)
        sums = F.aggregate(part, F.array(F.lit(0.0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
        return let(sums, lambda s: windows(s, lo, at))

    def widen(s: Column) -> Column:
        before = F.translate(F.substring(run, F.lit(1), s["start"]), "/", "=")
        after = F.translate(run.substr(s["end"] + 1, F.length(run)), "/", "=")
        return F.struct((s["start"] - F.length(F.substring_index(before, "=", -1))).cast("int").alias("start"),
                        (s["end"] + F.length(F.substring_index(after, "=", 1))).cast("int").alias("end"))

    def merge(acc: Column, s: Column) -> Column:
        old = F.element_at(acc, -1)
        both = F.array(F.struct(old["start"].alias("start"), F.greatest(old["end"], s["end"]).alias("end")))
        return (F.when(F.size(acc) == 0, F.array(s)).when(s["start"] > old["end"], F.concat(acc, F.array(s)))
                .when(s["end"] <= old["end"], acc).otherwise(F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), both)))

    found_ = let(over, lambda scores: F.flatten(F.transform(
        F.sequence(F.lit(0), F.size(scores), F.lit(4 * m)), lambda at: core(scores, at))))
    none = F.array().cast(SPAN)
    met = lambda spans: F.aggregate(F.array_sort(spans), none, merge)
    # merged before they are widened, so that a long run is not read for each of its stretches
    return met(F.transform(met(F.transform(found_, lambda s: F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end")))), widen))


def markov_spans(text: Column, ratios: list[float], taken: Column, min_chars: int, threshold: float) -> Column:
    """Spans that the models call random and no span of ``taken`` overlaps:
    whole runs, else the random stretches of a run."""
    table_ = F.from_json(F.lit(json.dumps(ratios)), "array<double>")   # folded to a constant
    pattern = f"{RUN}{{{min_chars},}}"

    def random(run: Column) -> Column:
        total = F.aggregate(pair_places(run), F.lit(0.0), lambda acc, p: acc + F.get(table_, p.cast("int")))
        return total / (F.length(run) - 1) >= threshold

    def of_run(x: Column) -> Column:
        at = x["span"]["start"]
        inner = F.transform(stretches(x["run"], table_, min_chars, threshold),
                            lambda s: F.struct((s["start"] + at).alias("start"), (s["end"] + at).alias("end")))
        free = lambda s: ~F.exists(taken, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"]))
        return F.when(random(x["run"]) & free(x["span"]), F.array(x["span"])).otherwise(F.filter(inner, free))

    runs = F.arrays_zip(found(text, pattern).alias("span"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("run"))
    return F.flatten(F.transform(runs, of_run))


def scan(docs: DataFrame, ratios: list[float], text: str = "text", min_chars: int = 20, threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``spans``: array of (kind, start, end), ordered by start,
    then kind as in KINDS; positions are code points, end exclusive."""
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("spans", "__rules__", "__text__")]
    t = F.col("__text__")
    kind = lambda k, spans: F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(k).alias("rank"), s["end"].alias("end")))
    rules = rule_spans(t)
    found_ = docs.select(*keep, clean_text(F.col(f"`{text}`")).alias("__text__")).select(
        *keep, t, F.concat(*[kind(KINDS.index(k), rules[k]) for k in KINDS[:3]]).alias("__rules__"))
    more = markov_spans(t, ratios, F.col("__rules__"), min_chars, threshold)
    names = F.array(*[F.lit(k) for k in KINDS])
    every = F.sort_array(F.concat("__rules__", kind(3, more)))
    return found_.select(*keep, F.transform(every, lambda s: F.struct(
        F.get(names, s["rank"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(scanned: DataFrame, text: str = "text", spans: str = "spans", mark: str = "[SECRET]") -> DataFrame:
    """``scanned`` with every span of the text replaced by ``mark`` (overlapping
    spans by one); a null text stays null."""
    t = F.col(f"`{text}`")
    first = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = F.concat(acc["out"], t.substr(acc["pos"] + 1, F.greatest(s["start"] - acc["pos"], F.lit(0))), F.lit(mark))
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"),
                        F.when(s["start"] < acc["pos"], acc["out"]).otherwise(fresh).alias("out"))

    done = F.aggregate(F.col(spans), first, step)
    whole = F.concat(done["out"], t.substr(done["pos"] + 1, F.length(t)))
    return scanned.withColumn(text, F.when(F.size(spans) > 0, whole).otherwise(t))


def op3_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of ``documents``: doc_id, n_assign, n_access,
    n_hex, base_sha256, spans, n_markov."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = scan(docs, train(labelled_samples(docs)))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return spans.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(of(*KINDS[:3])).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"), F.size(of("markov")).cast("long").alias("n_markov"))
