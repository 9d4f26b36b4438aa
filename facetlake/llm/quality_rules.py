"""Quality rules as a short-circuit cascade.

The statistics that the contract names are taken of every text. The further rules are cheap or dear tests of a text;
their cost and what each rejects are measured in the tasks on whole texts of a random sample of rows, spread over the table by a hash of the rows'
numbers, and each text then meets them in the order of rejections per second until one fails. The order changes the time and never the verdict.
Only eight sums come to the driver.

Defined cases: null text is empty, has no words and fails the base rule; null ids pass through as null;
repeated rows are judged alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetlake.llm.text import id_text, map_texts

#: Rows, on average, whose texts are timed to order the rules; a parameter of the ordering alone.
SAMPLE_ROWS = 400
_SYMBOLS = "#*$%&|<>"
_NO_SPACE = {ord(c): None for c in " \t\n\v\f\r"}
_LETTER = re.compile(r"[^\W\d_]")

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, failed_rule string"


def statistics(text: str) -> dict:
    """The contract's counts of one text. bytes.split() splits at exactly the six white-space bytes."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    repeats = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        if len(set(windows)) < len(windows):
            counts = Counter(windows)
            upto = 0
            for i, w in enumerate(windows):
                if counts[w] > 1:
                    repeats += i + 3 - max(i, upto)
                    upto = i + 3
    dup_lines = 0
    if "\n" in text:
        lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
        dup_lines = len(lines) - len(set(lines))
    return {"n_words": n, "word_chars": len(text) - sum(map(text.count, " \t\n\v\f\r")), "n_symbols": sum(map(text.count, _SYMBOLS)), "n_dup_lines": dup_lines, "n_repeat_words": repeats}


def base_failed(s: dict) -> bool:
    return s["n_words"] < 50 or 100 * s["n_repeat_words"] > 50 * s["n_words"]


#: name -> whether a text breaks the rule, given the text and its statistics. Thresholds are those published for web text, widened.
RULES: dict[str, Callable[[str, dict], bool]] = {
    "symbols": lambda t, s: 10 * s["n_symbols"] > s["n_words"],
    "word_length": lambda t, s: not 2 * s["n_words"] <= s["word_chars"] <= 14 * s["n_words"],
    "duplicate_lines": lambda t, s: 2 * s["n_dup_lines"] > t.count("\n") + 1,
    "few_letters": lambda t, s: 2 * len(_LETTER.findall(t)) < s["word_chars"],
    "shouting": lambda t, s: 2 * sum(map(str.isupper, t)) > s["word_chars"],
    "long_words": lambda t, s: 20 * sum(len(w) > 40 for w in t.split()) > s["n_words"],
    "bullets": lambda t, s: 10 * sum(x.lstrip()[:1] in ("-", "*", "•") for x in t.split("\n") if x) > 9 * (t.count("\n") + 1),
    "ellipses": lambda t, s: t.count("\n") >= 3 and 10 * sum(x.rstrip().endswith(("...", "…")) for x in t.split("\n")) > 3 * (t.count("\n") + 1),
}


def measure(texts: Iterable[str], rules: dict[str, Callable] = RULES) -> dict[str, tuple[float, int]]:
    """Of each rule the seconds that it took over the texts that pass the base rule, and how many it rejected."""
    known = [(t, s) for t in texts if not base_failed(s := statistics(t))]
    out = {}
    for name, rule in rules.items():
        began = time.perf_counter()
        rejected = sum(rule(t, s) for t, s in known)
        out[name] = (time.perf_counter() - began, rejected)
    return out


def order_rules(measured: dict[str, tuple[float, int]]) -> list[str]:
    """Rule names by rejections per second of work; ties by cost, then name."""
    return sorted(measured, key=lambda k: (-measured[k][1] / (measured[k][0] + 1e-9), measured[k][0], k))


def sampled_order(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """The order of the rules by what they cost and reject on a sample of the rows."""
    of = 1 << 30
    share = min(of, max(1, round(of * sample_rows / max(1, rows.count()))))
    picked = rows.withColumn("_n", F.monotonically_increasing_id()).where(F.pmod(F.xxhash64("_n"), F.lit(of)) < share)

    def work(ids: list, texts: list) -> dict:
        found = measure(texts)
        return {"rule": list(found), "seconds": [s for s, _ in found.values()], "rejected": [n for _, n in found.values()]}

    sums = map_texts(picked, work, "rule string, seconds double, rejected long").groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"))
    measured = {r.rule: (r.seconds, r.rejected) for r in sums.collect()}  # one row a rule
    return order_rules({k: measured.get(k, (0.0, 0)) for k in RULES})


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document with its statistics, verdict and the first rule that it broke ("base" or a name, else null).

    ``failed_rule`` depends on the measured order where a text breaks several rules; ``kept`` does not.
    """
    rows = id_text(docs, id_col, text_col)
    order = sampled_order(rows, sample_rows)

    def work(ids: list, texts: list) -> dict:
        out: dict[str, list] = {k: [] for k in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rule")}
        for i, t in zip(ids, texts, strict=True):
            s = statistics(t)
            failed = "base" if base_failed(s) else next((k for k in order if RULES[k](t, s)), None)
            for k, v in {"doc_id": i, **s, "base_failed": failed == "base", "kept": failed is None, "failed_rule": failed}.items():
                out[k].append(v)
        return out

    return map_texts(rows, work, SCHEMA)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, generate_subscripts(x, 1) AS i, unnest(x) AS word FROM (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS x FROM d)),
g AS (SELECT r, i, word, lead(word) OVER o AS b, lead(word, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
m AS (SELECT *, c IS NOT NULL AND count(*) OVER (PARTITION BY r, word, b, c) > 1 AS again FROM g),
n AS (SELECT r, word, again OR coalesce(lag(again) OVER o, false) OR coalesce(lag(again, 2) OVER o, false) AS repeated FROM m WINDOW o AS (PARTITION BY r ORDER BY i)),
words AS (SELECT r, count(*) AS n_words, sum(len(word))::BIGINT AS word_chars, count(*) FILTER (repeated) AS n_repeat_words FROM n GROUP BY r),
split AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
lines AS (SELECT r, count(*) AS n_lines, count(*) FILTER (regexp_matches(line, '[^\x20\x09-\x0D]')) - count(DISTINCT line) FILTER (regexp_matches(line, '[^\x20\x09-\x0D]')) AS n_dup_lines,
  count(*) FILTER (regexp_matches(line, '^[\s\x0b\x1c-\x1f\x85\p{Z}]*[-*•]')) AS bullets, count(*) FILTER (regexp_matches(line, '(\.\.\.|…)[\s\x0b\x1c-\x1f\x85\p{Z}]*$')) AS ellipses FROM split GROUP BY r),
s AS (SELECT d.r, doc_id, t, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, n_lines, bullets, ellipses
  FROM d JOIN lines USING (r) LEFT JOIN words USING (r)),
k AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  10 * n_symbols > n_words OR word_chars NOT BETWEEN 2 * n_words AND 14 * n_words OR 2 * n_dup_lines > n_lines
  OR 2 * len(regexp_extract_all(t, '[\p{L}\p{Nl}\p{No}]')) < word_chars OR 2 * len(regexp_extract_all(t, '\p{Lu}')) > word_chars
  OR 20 * len(list_filter(regexp_extract_all(t, '[^\s\x0b\x1c-\x1f\x85\p{Z}]+'), lambda x: len(x) > 40)) > n_words
  OR 10 * bullets > 9 * n_lines OR (n_lines > 3 AND 10 * ellipses > 3 * n_lines) AS broken FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT broken AS kept FROM k
"""
