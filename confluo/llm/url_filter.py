"""URL filters: rules by longest prefix, and an empirical-Bayes reputation of hosts for what no rule covers.

Pages that a rule judges are the labelled outcomes (or a table of outcomes is given). Outcomes are summed by host,
registered domain and suffix: the last label, or the last two where SECOND_LEVEL has them; the domain is the suffix and
one label more. Each level's mean shrinks towards its parent's through a beta prior, whose pseudo-counts the method of
moments sets from what that level's outcomes spread beyond the binomial chance of their numbers; a host is blocked if
the upper posterior bound of its allowed share is below `least`. The bound is mean + WIDTH standard deviations of the
beta posterior: SQL has no beta quantile, from which it differs by some hundredths for hosts of a few pages.

Edge cases: a null url or one without "://" has an empty host and path; an empty host has no domain or suffix and
falls to the overall mean; with no outcomes at all, the mean is 1/2 and nothing is blocked; repeated rows count each; an
empty table gives no rows; urls of any length are read whole; columns other than id and url are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (rule, verdict): host suffix, then path prefix.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: Public suffixes of two labels; others can be given.
SECOND_LEVEL = (
    "co.uk org.uk ac.uk gov.uk ltd.uk me.uk com.au net.au org.au edu.au gov.au co.nz org.nz govt.nz co.jp or.jp ne.jp ac.jp go.jp "
    "co.kr or.kr com.cn net.cn org.cn gov.cn com.hk com.tw com.sg com.my co.id co.th co.in net.in org.in gov.in com.br org.br "
    "gov.br com.ar com.mx com.co com.pe com.tr gov.tr com.pl co.za org.za co.il org.il com.ua com.eg com.sa com.ng co.ke"
).split()
LEAST, WIDTH, MOST_STRENGTH = 0.5, 1.64, 1000.0


def url_host(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end; A-Z in lower case."""
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to "?", "#" or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits a host (itself or a subdomain) and path; null if none does."""
    tries = []
    for rule, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        h, p = rule.split("/", 1)
        tries.append(F.when(((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(f"/{p}")), F.lit(rule)))
    return F.coalesce(*tries) if tries else F.lit(None).cast("string")


def _levels(host: Column, second_level: list[str]) -> tuple[Column, Column]:
    """Registered domain and suffix of a host."""
    two = F.substring_index(host, ".", -2).isin(second_level)
    return F.when(two, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2)), F.when(two, F.substring_index(host, ".", -2)).otherwise(F.substring_index(host, ".", -1))


def reputation(outcomes: DataFrame, least: float = LEAST, width: float = WIDTH, second_level: list[str] = SECOND_LEVEL) -> dict[str, DataFrame]:
    """Posterior (mean, upper) of allowed pages, by level: overall (one row), suffix, domain and host.

    outcomes: host, good (long), n (long); one row a host. Overall: Beta(1, 1).
    """
    host = outcomes.select(F.col("host").alias("key"), _levels(F.col("host"), second_level)[0].alias("domain"), "good", "n")
    domain = host.groupBy(F.col("domain").alias("key")).agg(F.sum("good").alias("good"), F.sum("n").alias("n")).withColumn("suffix", _levels(F.col("key"), second_level)[1])
    suffix = domain.groupBy(F.col("suffix").alias("key")).agg(F.sum("good").alias("good"), F.sum("n").alias("n")).withColumn("all", F.lit(""))
    overall = suffix.agg(F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit("").alias("key"), "good", "n", ((F.col("good") + 1) / (F.col("n") + 2)).alias("mean"), (F.col("n") + 2).cast("double").alias("weight"))
    levels = {"overall": overall}
    for name, own, up_key in (("suffix", suffix, "all"), ("domain", domain, "suffix"), ("host", host, "domain")):
        up = levels[{"suffix": "overall", "domain": "suffix", "host": "domain"}[name]].select(F.col("key").alias(up_key), F.col("mean").alias("up"))
        t = own.join(up, up_key)
        # method of moments: a share of n varies by u (1 - u) (1 + (n - 1) rho) / n, and rho is 1 / (pseudo-counts + 1)
        q = F.col("up") * (1 - F.col("up"))
        rho = (F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col("up"), 2)) - F.sum(q)) / F.nullif(F.sum((F.col("n") - 1) * q), F.lit(0.0))
        # no spread beyond chance, or none that can be told from it: the strongest prior
        spread = t.agg(rho.alias("rho")).select(F.greatest(F.lit(1.0), F.least(F.lit(MOST_STRENGTH), F.when(F.col("rho") > 0, 1 / F.col("rho") - 1).otherwise(MOST_STRENGTH))).alias("k"))
        # one row, by construction
        t = t.crossJoin(F.broadcast(spread))
        levels[name] = t.select("key", "good", "n", ((F.col("good") + F.col("k") * F.col("up")) / (F.col("n") + F.col("k"))).alias("mean"), (F.col("n") + F.col("k")).alias("weight"))
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return {k: v.select("key", "mean", (F.col("mean") + width * sd < least).alias("bad")) for k, v in levels.items()}


def judge(pages: DataFrame, rules=RULES, outcomes: DataFrame | None = None, least: float = LEAST, width: float = WIDTH, id_col: str = "page_id", url_col: str = "url", second_level: list[str] = SECOND_LEVEL) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, level (what decided: rule, host, domain, suffix, overall)."""
    base = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    base = base.withColumn("rule", match_rule(F.col("host"), F.col("path"), rules))
    allows = [r for r, v in rules if v == "allow"]
    if outcomes is None:
        judged = base.where(F.col("rule").isNotNull() & (F.col("host") != ""))
        outcomes = judged.groupBy("host").agg(F.sum(F.col("rule").isin(allows).cast("long")).alias("good"), F.count("*").alias("n"))
    rep = reputation(outcomes, least, width, second_level)
    # reputations go to distinct hosts first, so a host with a third of all pages is one row in every join but the last
    hosts = base.where("rule IS NULL").select("host").distinct()
    domain, suffix = _levels(F.col("host"), second_level)
    hosts = hosts.withColumn("domain", domain).withColumn("suffix", suffix)
    for name in ("host", "domain", "suffix"):
        hosts = hosts.join(rep[name].select(F.col("key").alias(name), F.col("bad").alias(f"{name}_bad")), name, "left")
    hosts = hosts.crossJoin(F.broadcast(rep["overall"].select(F.col("bad").alias("overall_bad"))))
    names = ("host", "domain", "suffix", "overall")
    hosts = hosts.select("host", F.coalesce(*(F.col(f"{x}_bad") for x in names)).alias("bad"), F.coalesce(*(F.when(F.col(f"{x}_bad").isNotNull(), F.lit(x)) for x in names)).alias("level"))
    # a join, not a broadcast: hosts grow with the input; AQE splits a hot host's pages
    known = base.where("rule IS NOT NULL").select("page_id", "host", "path", "rule", F.when(F.col("rule").isin(allows), "allow").otherwise("block").alias("verdict"), F.lit("rule").alias("level"))
    rest = base.where("rule IS NULL").join(hosts, "host", "left").select("page_id", "host", "path", "rule", F.when(F.col("bad"), "block").otherwise("allow").alias("verdict"), "level")
    return known.unionByName(rest)


def _sql(rules=RULES) -> str:
    order = sorted(rules, key=lambda r: (-len(r[0]), r[0]))
    case = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}') THEN '{r}'" for r, _ in order for h, p in [r.split("/", 1)])
    allow = ", ".join(f"'{r}'" for r, v in rules if v == "allow")
    two = f"array_to_string(string_split({{0}}, '.')[-2:], '.') IN ({', '.join(repr(x) for x in SECOND_LEVEL)})"
    domain = lambda h: f"CASE WHEN {two.format(h)} THEN array_to_string(string_split({h}, '.')[-3:], '.') ELSE array_to_string(string_split({h}, '.')[-2:], '.') END"
    suffix = lambda h: f"CASE WHEN {two.format(h)} THEN array_to_string(string_split({h}, '.')[-2:], '.') ELSE string_split({h}, '.')[-1] END"
    level = lambda name, own, key, up: f"""
{name}_k AS (SELECT greatest(1.0, least({MOST_STRENGTH}, CASE WHEN rho > 0 THEN 1 / rho - 1 ELSE {MOST_STRENGTH} END)) AS k FROM
  (SELECT (sum(n * power(good / n - u.mean, 2)) - sum(u.mean * (1 - u.mean))) / nullif(sum((n - 1) * u.mean * (1 - u.mean)), 0) AS rho FROM {own} o JOIN {up} u ON o.up = u.key)),
{name} AS (SELECT o.key, (good + k * u.mean) / (n + k) AS mean, n + k AS weight FROM {own} o JOIN {up} u ON o.up = u.key, {name}_k)"""  # noqa: E731
    bad = f"mean + {WIDTH} * sqrt(mean * (1 - mean) / (weight + 1)) < {LEAST}"
    return rf"""
WITH u AS (SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
b AS (SELECT *, CASE {case} END AS rule FROM u),
oh AS (SELECT host AS key, {domain("host")} AS up, sum((rule IN ({allow}))::INT)::DOUBLE AS good, count(*)::DOUBLE AS n FROM b WHERE rule IS NOT NULL AND host <> '' GROUP BY host),
od AS (SELECT up AS key, {suffix("up")} AS up, sum(good) AS good, sum(n) AS n FROM oh GROUP BY ALL),
os AS (SELECT up AS key, '' AS up, sum(good) AS good, sum(n) AS n FROM od GROUP BY ALL),
overall AS (SELECT '' AS key, (coalesce(sum(good), 0) + 1) / (coalesce(sum(n), 0) + 2) AS mean, coalesce(sum(n), 0) + 2 AS weight FROM os),
{level("ls", "os", "suffix", "overall")},
{level("ld", "od", "domain", "ls")},
{level("lh", "oh", "host", "ld")},
rep AS (SELECT key, {bad} AS bad, 1 AS l FROM lh UNION ALL SELECT key, {bad}, 2 FROM ld UNION ALL SELECT key, {bad}, 3 FROM ls)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ({allow}) THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN coalesce(h.bad, d.bad, s.bad, (SELECT {bad} FROM overall)) THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN rule IS NOT NULL THEN 'rule' WHEN h.bad IS NOT NULL THEN 'host' WHEN d.bad IS NOT NULL THEN 'domain' WHEN s.bad IS NOT NULL THEN 'suffix' ELSE 'overall' END AS level
FROM b LEFT JOIN rep h ON h.l = 1 AND h.key = host
LEFT JOIN rep d ON d.l = 2 AND d.key = {domain("host")}
LEFT JOIN rep s ON s.l = 3 AND s.key = {suffix("host")}
"""


SQL = _sql()
