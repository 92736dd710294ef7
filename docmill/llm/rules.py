"""Quality rules that vote, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage
from .weak import ABSTAIN, ALARMS, BAD, GOOD, GOOD_SHARE, OTHERS, OWN, START, STEPS, fit_votes

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words of a window in which distinct words are counted: long texts repeat words, but not within one.
WINDOW = 3000
RULES = ("vote_symbols", "vote_lines", "vote_repeats", "vote_length", "vote_capitals", "vote_variety")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_distinct_words")
#: Names of results and of steps on the way.
RESERVED = (*MEASURES, *RULES, "base_failed", "quality", "kept", "_words", "_lines")


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once for each row."""
    return F.transform(F.array(value), body)[0]


def count_of(text: Column, characters: str) -> Column:
    """How many characters of a text are among these."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def distinct_words(words: Column) -> Column:
    """Distinct words of each window of WINDOW words, added up; of a text that is no longer, its distinct words."""
    n = F.size(words)
    windows = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / WINDOW).cast("int")), lambda k: F.size(F.array_distinct(F.slice(words, k * WINDOW + 1, WINDOW))))
    return F.when(n <= WINDOW, F.size(F.array_distinct(words))).otherwise(F.aggregate(windows, F.lit(0), lambda a, x: a + x))


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more.

    Each window is one number: a hash above, its place below, so that a plain sort brings equal windows together;
    neighbours that are also equal word by word are marked. Each marked window covers its words, without those that
    the next one covers.
    """

    def of(w: Column) -> Column:
        n = F.size(w)
        bits = F.ceil(F.log2(n + F.lit(2))).cast("int")

        def marked(s: Column) -> Column:
            def place(k: Column) -> Column:
                return F.call_function("shiftright", F.call_function("shiftleft", k, 64 - bits), 64 - bits).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)

            def same(a: Column, b: Column) -> Column:
                p, q = place(a), place(b)
                high = F.call_function("shiftright", a, bits) == F.call_function("shiftright", b, bits)
                words = [F.get(w, (p + k).cast("int")) == F.get(w, (q + k).cast("int")) for k in range(3)]
                return high & words[0] & words[1] & words[2]

            def twin(x: Column, k: Column) -> Column:
                return F.coalesce(same(x, F.get(s, k - 1)), F.lit(False)) | F.coalesce(same(x, F.get(s, k + 1)), F.lit(False))

            places = F.sort_array(F.transform(F.filter(s, twin), place))
            return let(
                places,
                lambda p: F.coalesce(
                    F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x),
                    F.lit(0),
                ),
            )

        keyed = F.transform(
            F.slice(w, 1, n - 2),
            lambda x, i: F.call_function("shiftleft", F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)), bits).bitwiseOR(i.cast("long")),
        )
        return F.when(n < 4, F.lit(0).cast("long")).otherwise(let(F.sort_array(keyed), marked))

    return let(words, of)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals, n_distinct_words.

    n_distinct_words counts afresh in each window of WINDOW words. A null text has none of anything, and an empty one too. Whole texts are measured, each in one row.
    A column of docs that has the name of a result (RESERVED, in any case) comes back with `_` after its name.
    """
    names = []
    for c in docs.columns:
        while c.lower() in RESERVED or c.lower() in [n.lower() for n in names]:
            c += "_"
        names.append(c)
    text = names[docs.columns.index(text)]
    docs = docs.toDF(*names)
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(t, SPACE), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    step = docs.withColumns({"_words": words, "_lines": lines})
    return step.select(
        *[docs[c] for c in docs.columns],
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        count_of(t, SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        count_of(t, CAPITALS).cast("long").alias("n_capitals"),
        distinct_words(F.col("_words")).cast("long").alias("n_distinct_words"),
    )


def vote(measured: DataFrame) -> DataFrame:
    """Add a vote of each rule: BAD, GOOD or ABSTAIN, and base_failed."""
    n, chars = F.col("n_words"), F.col("word_chars")

    def rule(bad: Column, good: Column, silent: Column | None = None) -> Column:
        out = F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)
        return F.when(n == 0, ABSTAIN).otherwise(out if silent is None else F.when(silent, ABSTAIN).otherwise(out))

    lines, dup, rep = F.col("n_lines"), F.col("n_dup_lines"), F.col("n_repeat_words")
    return measured.withColumns({
        "vote_symbols": rule(100 * F.col("n_symbols") > 4 * chars, 100 * F.col("n_symbols") < chars),
        "vote_lines": rule((dup >= 3) & (100 * dup > 25 * lines), 100 * dup < 10 * lines, lines < 3),
        "vote_repeats": rule(100 * rep > 50 * n, 100 * rep < 25 * n, n < 50),
        "vote_length": rule((chars < 2 * n) | (10 * chars > 90 * n), (10 * chars > 35 * n) & (10 * chars < 75 * n)),
        "vote_capitals": rule(100 * F.col("n_capitals") > 40 * chars, 100 * F.col("n_capitals") < 15 * chars),
        "vote_variety": rule(100 * F.col("n_distinct_words") < 25 * n, 100 * F.col("n_distinct_words") > 45 * n, n < 50),
        "base_failed": (n < 50) | (100 * rep > 50 * n),
    })


def judge(measured: DataFrame) -> DataFrame:
    """Votes, their trust from all rows, the probability that a document is good, and kept. `measured` is staged."""
    voted = vote(measured)
    trust = fit_votes(voted, list(RULES))
    quality = 1 - trust.column([F.col(r) for r in RULES])
    return voted.withColumn("quality", quality).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))


def op6_voting_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdicts of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    measured = stage(measure(docs).drop("text"), "rules")
    return judge(measured).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("quality", 6).alias("quality"))


def _sql() -> str:
    """Measures and votes by lists and joins; expectation-maximisation as a recursive query with a row for each step."""
    n = len(RULES)

    def by_pair(own: float, other: float) -> str:
        return "[" + ", ".join("[" + ", ".join(f"{own if k == j else other}::DOUBLE" for j in range(n)) + "]" for k in range(n)) + "]"

    def each(body: str, over: str = f"range(1, {n + 1})", name: str = "k") -> str:
        return f"list_transform({over}, lambda {name}: {body})"

    def total(body: str) -> str:
        """Over the patterns of votes; `of` has the documents of each kind."""
        return f"coalesce(list_sum({each(body, 'found', 'p')}), 0)"

    seen = "(1 - (1 - alarms[j]) * (1 - sees[k][j]))"
    odds = f"exp(ln(kinds[k] / (1 - list_sum(kinds))) + list_sum({each(f'CASE p.v[j] WHEN 1 THEN ln({seen} / alarms[j]) WHEN 0 THEN ln((1 - {seen}) / (1 - alarms[j])) ELSE 0 END', name='j')}))"
    on_kind, votes_on_kind = total("CASE WHEN p.v[j] = 1 THEN p.of[k] ELSE 0 END"), total("CASE WHEN p.v[j] >= 0 THEN p.of[k] ELSE 0 END")
    alarmed, voted = total("CASE WHEN p.v[j] = 1 THEN p.n - list_sum(p.of) ELSE 0 END"), total("CASE WHEN p.v[j] >= 0 THEN p.n ELSE 0 END")
    see_for, see_all = by_pair(OWN[0], OTHERS[0]), by_pair(sum(OWN), sum(OTHERS))
    from_kinds = f"list_sum({each(f'{on_kind} * alarms[j] / {seen}')})"
    blank = "concat(chr(32), chr(9), chr(10), chr(11), chr(12), chr(13))"
    return f"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS l,
    list_filter(string_split(t, chr(10)), lambda x: translate(x, {blank}, '') <> '') AS lines FROM t
),
i AS (SELECT doc_id, unnest(l) AS word, unnest(range(len(l))) AS i FROM w),
g AS (SELECT doc_id, unnest(list_transform(range(1, len(l) - 1), lambda i: l[i:i + 2])) AS g, unnest(range(1, len(l) - 1)) AS i FROM w WHERE len(l) > 2),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM twice, range(3) r(o) GROUP BY doc_id),
varied AS (SELECT doc_id, count(DISTINCT (i // {WINDOW}, word)) AS n_distinct FROM i GROUP BY doc_id),
m AS (
  SELECT doc_id, len(l) AS n_words, length(translate(t, {blank}, '')) AS word_chars, length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines,
    length(t) - length(translate(t, '{CAPITALS}', '')) AS n_capitals, coalesce(n_distinct, 0) AS n_distinct
  FROM w LEFT JOIN repeated USING (doc_id) LEFT JOIN varied USING (doc_id)
),
v AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, CASE WHEN n_words = 0 THEN [-1, -1, -1, -1, -1, -1] ELSE [
    CASE WHEN 100 * n_symbols > 4 * word_chars THEN 1 WHEN 100 * n_symbols < word_chars THEN 0 ELSE -1 END,
    CASE WHEN n_lines < 3 THEN -1 WHEN n_dup_lines >= 3 AND 100 * n_dup_lines > 25 * n_lines THEN 1 WHEN 100 * n_dup_lines < 10 * n_lines THEN 0 ELSE -1 END,
    CASE WHEN n_words < 50 THEN -1 WHEN 100 * n_repeat_words > 50 * n_words THEN 1 WHEN 100 * n_repeat_words < 25 * n_words THEN 0 ELSE -1 END,
    CASE WHEN word_chars < 2 * n_words OR 10 * word_chars > 90 * n_words THEN 1 WHEN 10 * word_chars > 35 * n_words AND 10 * word_chars < 75 * n_words THEN 0 ELSE -1 END,
    CASE WHEN 100 * n_capitals > 40 * word_chars THEN 1 WHEN 100 * n_capitals < 15 * word_chars THEN 0 ELSE -1 END,
    CASE WHEN n_words < 50 THEN -1 WHEN 100 * n_distinct < 25 * n_words THEN 1 WHEN 100 * n_distinct > 45 * n_words THEN 0 ELSE -1 END] END AS v FROM m
),
patterns AS (SELECT coalesce(list(struct_pack(v := v, n := n) ORDER BY v), []) AS pats FROM (SELECT v, count(*)::DOUBLE AS n FROM v GROUP BY v)),
em AS (
  SELECT 0 AS step, {each(f"{START[3] / n}::DOUBLE")} AS kinds, {by_pair(START[0], START[1])} AS sees, {each(f"{START[2]}::DOUBLE")} AS alarms
  UNION ALL
  SELECT step + 1, {each(f"({total('p.of[k]')} + {GOOD_SHARE[1] / n}) / ({total('p.n')} + {sum(GOOD_SHARE)})")},
    {each(each(f"({on_kind} * sees[k][j] / {seen} + {see_for}[k][j]) / ({votes_on_kind} + {see_all}[k][j])", name="j"))},
    {each(f"({alarmed} + {from_kinds} + {ALARMS[0]}) / ({voted} + {sum(ALARMS)})", name="j")}
  FROM (
    SELECT em.*, list_transform(odds, lambda p: struct_pack(v := p.v, n := p.n, of := list_transform(p.o, lambda x: p.n * x / (1 + list_sum(p.o))))) AS found
    FROM (SELECT em.*, {each(f"struct_pack(v := p.v, n := p.n, o := {each(odds)})", "pats", "p")} AS odds FROM em, patterns WHERE step < {STEPS}) em
  ) em
),
judged AS (
  SELECT v.*, 1 / (1 + list_sum({each(odds)})) AS good FROM (SELECT v.*, struct_pack(v := v.v) AS p, kinds, sees, alarms FROM v, em WHERE step = {STEPS}) v
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND good >= 0.5 AS kept, round(good, 6) AS quality
FROM judged
"""


OP6_SQL = _sql()
