"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a pattern over a URL's normal form (host and path joined):

* ``||`` at the start: the pattern begins at the host or one of its parent
  domains (``||example.net/en/`` fits ``a.example.net/en/1``);
* ``*``: any characters; ``^``: one character that is neither a letter nor a
  digit, or the end; everything else stands for itself;
* a rule with ``host_only`` sees the host alone, never the path.

A literal token is a run of ASCII letters and digits of the pattern that must
be a whole token of every URL that it fits (both neighbours are fixed and
neither letter nor digit).  Spark counts how often each rule token occurs in
the URLs of the table, and every rule is indexed under its rarest one.  A URL
is cut into tokens, they fetch the candidate rules, and only those (and rules
without any token) run their regular expression.  Of the rules that fit, the
one with the highest tier wins, then the longest, then the first listed.

The rules are a parameter and are kept by every task; the table is read once
for the token counts and once for the verdicts, without a shuffle of rows.

Edge cases: a null URL or one without ``://`` has an empty host and path and
no tokens; repeated rows are judged each; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = str.maketrans(UPPER, LOWER)
_TOKEN = re.compile(r"[0-9a-z]+")


@dataclass(frozen=True)
class Rule:
    pattern: str
    action: str          # "allow" or "block"
    tier: int = 0
    host_only: bool = False

    def regex(self) -> str:
        body, out = self.pattern.removeprefix("||"), []
        for c in body:
            out.append(".*" if c == "*" else "(?:[^0-9A-Za-z]|\\Z)" if c == "^" else re.escape(c))
        return (r"^(?:[^/]*\.)?" if self.pattern.startswith("||") else "") + "".join(out)

    def tokens(self) -> list[str]:
        """Literal tokens that every URL this rule fits must have."""
        anchored = self.pattern.startswith("||")
        body = self.pattern.removeprefix("||").translate(_FOLD)
        out = []
        for m in _TOKEN.finditer(body):
            before = anchored if m.start() == 0 else body[m.start() - 1] != "*"
            after = m.end() < len(body) and body[m.end()] != "*"
            if before and after:
                out.append(m.group())
        return out


#: Words of junk hosts, each a whole name or a part between separators of it
#: (dots, hyphens).  Words that ordinary hosts have as well (pharmacy, track,
#: spam, slots, sex) stand only with the neighbour that makes them junk.
JUNK_WORDS = {
    "gambling": ("casino", "casinos", "poker", "roulette", "blackjack", "baccarat", "jackpot", "jackpots",
                 "gambling", "online-slots", "free-slots", "slot-machine", "slot-machines"),
    "betting": ("bets", "betting", "sportsbook", "sportsbooks", "bookmaker", "bookmakers", "wagering"),
    "pharmacy": ("pills", "viagra", "cialis", "levitra", "tramadol", "xanax", "cheap-meds", "cheap-pharmacy",
                 "online-pharmacy", "no-prescription"),
    "adult": ("porn", "porno", "xxx", "hentai", "milf", "camgirls", "escorts", "nudes", "sex-cams", "sex-chat",
              "adult-dating", "adult-x", "adult-xxx", "adult-cams"),
    "ad tracking": ("ads", "adserver", "adservers", "adclick", "adtrack", "adtracker", "adtracking", "ad-track",
                    "ad-tracker", "ad-tracking", "ad-server", "click-track", "clicktracker", "popads", "popunder"),
    "spam": ("spam-farm", "spamfarm", "link-farm", "linkfarm", "content-farm", "buy-backlinks", "seo-links",
             "payday-loan", "payday-loans", "replica-watches"),
}
#: Two rules a word: at the start of a host name, and after a hyphen in it.
JUNK_RULES = [Rule(start + word + "^", "block", host_only=True)
              for words in JUNK_WORDS.values() for word in words for start in ("||", "-")]

#: Paths that crawls hit by mistake: log-ins, interfaces, repositories, ads.
JUNK_PATHS = [Rule(p, "block") for p in ("/wp-login.php", "/wp-admin/", "/xmlrpc.php", "/phpmyadmin/", "/cgi-bin/", "/.git/",
                                         "/.env^", "/ads/*.html^")]


def normal_form(url: str | None) -> tuple[str, str]:
    """(host in lower case, path); both empty without ``://``."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    host, mark, rest = re.match(r"([^/?#]*)([/?#]?)(.*)", url[at + 3:], re.DOTALL).groups()
    return host.translate(_FOLD), re.match(r"[^?#]*", mark + rest).group() if mark == "/" else ""


class RuleIndex:
    """Rules by their rarest token; compiled when first used."""

    def __init__(self, rules: Sequence[Rule], counts: dict[str, int]):
        self.rules, self.always, self.by_token = list(rules), [], {}
        for i, rule in enumerate(self.rules):
            tokens = rule.tokens()
            if tokens:
                self.by_token.setdefault(min(tokens, key=lambda t: (counts.get(t, 0), t)), []).append(i)
            else:
                self.always.append(i)
        self._compiled: dict[int, re.Pattern] = {}

    def __getstate__(self):
        return self.__dict__ | {"_compiled": {}}

    def candidates(self, form: str) -> list[int]:
        """The rules whose expressions a URL runs."""
        return [*self.always, *(i for t in set(_TOKEN.findall(form.translate(_FOLD))) for i in self.by_token.get(t, ()))]

    def best(self, host: str, path: str) -> Rule | None:
        form = host + path
        found = None
        for i in self.candidates(form):
            if i not in self._compiled:
                self._compiled[i] = re.compile(self.rules[i].regex(), re.DOTALL)
            if self._compiled[i].search(host if self.rules[i].host_only else form):
                rank = self.rules[i].tier, len(self.rules[i].pattern), -i
                if found is None or rank > found:
                    found = rank
        return None if found is None else self.rules[-found[2]]


def token_frequencies(pages: DataFrame, rules: Sequence[Rule], url_col: str = "url") -> dict[str, int]:
    """How many URLs have each rule token (at most one count per rule token
    comes to the driver)."""
    wanted = sorted({t for r in rules for t in r.tokens()})
    if not wanted:
        return {}
    folded: Column = F.translate(F.col(url_col).cast("string"), UPPER, LOWER)
    tokens = F.array_intersect(F.split(folded, "[^0-9a-z]+"), F.array(*map(F.lit, wanted)))
    return {r.t: r.n for r in pages.select(F.explode(tokens).alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect()}


def judge(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """``(id, host, path, pattern, tier, verdict)`` of every row."""
    index = pages.sparkSession.sparkContext.broadcast(RuleIndex(rules, token_frequencies(pages, rules, url_col)))

    @pandas_udf("host string, path string, pattern string, tier int, verdict string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for urls in batches:
            out = []
            for url in urls:
                host, path = normal_form(url)
                rule = index.value.best(host, path)
                out.append((host, path, None, -1, default) if rule is None else
                           (host, path, rule.pattern, rule.tier, rule.action))
            yield pd.DataFrame(out, columns=["host", "path", "pattern", "tier", "verdict"]).astype({"tier": "int32"})

    return pages.select(F.col(id_col), of(F.col(url_col).cast("string")).alias("r")).select(F.col(id_col), "r.*")
