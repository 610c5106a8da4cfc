"""URL filter: rules, and for the URLs without one a ratio of character language models, in DataFrame operations alone."""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from wardlake.llm.common import checkpointed, looked_up, table

#: (verdict, rule); a rule is a host and the beginning of a path.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
ORDER = 4
#: Log ratios are whole numbers of 1 / SCALE.
SCALE = 1 << 32
#: How many sightings the next shorter context counts as.
BACK_OFF = 2.0
#: URLs with a rule are dealt to so many folds, and each is scored for the threshold by what the others hold.
FOLDS = 4
HELD = [f"_{k}" for k in range(FOLDS)]
_start, _end = "\x02" * ORDER, "\x03"


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL: empty strings where it is null or has no `://`."""
    form = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, form, k), F.lit("")) for k in (1, 2))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null where none does. Rules are a short constant list."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, name in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        own, slash, rest = name.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def grams(url: Column) -> Column:
    """One string for each character of the URL and its end: that character after the ORDER before it."""
    chars = F.split(F.concat(F.lit(_start), url, F.lit(_end)), "")
    return F.transform(F.sequence(F.lit(1), F.size(chars) - ORDER), lambda i: F.array_join(F.slice(chars, i, ORDER + 1), ""))


def log_ratios(counted: DataFrame, models: tuple[str, ...] = ("",)) -> DataFrame:
    """counted (g, and for each model, by the end of the column's name, allowed and blocked: sightings) with ratio, the logarithm
    of P(last character | those before it) among allowed URLs over that among blocked ones.

    Each probability backs off: p_k = (n(context, c) + BACK_OFF * p_(k-1)) / (n(context) + BACK_OFF), down to single
    characters with one sighting added to each. So the context used is as long as the data bear.
    """
    sides = [s + m for m in models for s in ("allowed", "blocked")]
    alone = Window.partitionBy("all")
    shorter = counted.groupBy(F.right("g", F.lit(1)).alias("g")).agg(*[F.sum(s).alias(s) for s in sides]).withColumn("all", F.lit(1))  # the alphabet
    shorter = shorter.select("g", *[((F.col(s) + 1.0) / (F.sum(s).over(alone) + F.count("*").over(alone))).alias(f"p_{s}") for s in sides])
    for k in range(1, ORDER + 1):
        context = Window.partitionBy(F.left("g", F.lit(k)))  # as many rows as there are characters, at most
        level = counted.groupBy(F.right("g", F.lit(k + 1)).alias("g")).agg(*[F.sum(s).alias(s) for s in sides])
        level = level.select("g", *sides, *[F.sum(s).over(context).alias(f"n_{s}") for s in sides], F.right("g", F.lit(k)).alias("tail"))
        level = level.join(shorter.select(F.col("g").alias("tail"), *[f"p_{s}" for s in sides]), "tail")
        shorter = level.select("g", *sides, *[((F.col(s) + BACK_OFF * F.col(f"p_{s}")) / (F.col(f"n_{s}") + BACK_OFF)).alias(f"p_{s}") for s in sides])
    return shorter.select("g", *sides, *[(F.log(f"p_allowed{m}") - F.log(f"p_blocked{m}")).alias(f"ratio{m}") for m in models])


def fold_of(url: Column) -> Column:
    return (F.instr(F.lit("0123456789abcdef"), F.left(F.md5(url.cast("binary")), F.lit(1))) - 1) % FOLDS


@dataclass
class UrlModel:
    """ratios: g, n (its sightings), ratio (in units of 1 / SCALE: that of the whole model, then those of the models without
    each fold) for every distinct string of characters that was seen; threshold: URLs whose mean ratio reaches it are allowed."""

    ratios: DataFrame
    threshold: float

    def scored(self, urls: DataFrame, model: Column | None = None) -> DataFrame:
        """Distinct url with url_score, the mean log ratio over its characters, by the whole model or the one of that number.
        Whole numbers are summed, so the order of rows changes nothing."""
        asked = urls.select("url", (F.lit(0) if model is None else model).alias("model"), F.explode(grams(F.col("url"))).alias("g"))
        looked = looked_up(asked, self.ratios, "g", "ratio")
        return looked.groupBy("url").agg((F.sum(F.get("ratio", F.col("model"))) / (F.count("*") * float(SCALE))).alias("url_score"))


def fit(judged: DataFrame) -> tuple[UrlModel, DataFrame]:
    """The model, and url, n, verdict and url_score of each distinct URL. judged: distinct url, n (its rows) and verdict
    (allow, block or null). All rows count: those without a verdict add what characters and contexts there are, the others
    train the two models. URLs with a verdict are scored by the models without their own fold, as those without one are
    scored by models that never saw them. On those scores (in cells of a histogram of a fixed width) the threshold is where
    the balanced accuracy is best, in the middle between the cells on both sides of it. With one kind of verdict or none it
    is 0."""
    models = ("", *HELD)
    seen = judged.select(F.explode(grams(F.col("url"))).alias("g"), "n", "verdict", fold_of(F.col("url")).alias("fold"))
    side = lambda v, k: F.sum(F.when((F.col("verdict") == v) & (F.lit(True) if k is None else F.col("fold") != k), F.col("n")).otherwise(0))
    sums = [side(v, k).alias(name + m) for k, m in zip((None, *range(FOLDS)), models, strict=True) for v, name in (("allow", "allowed"), ("block", "blocked"))]
    counted = checkpointed(seen.groupBy("g").agg(*sums, F.count("*").alias("n")))
    ratios = log_ratios(counted, models).select("g", F.array(*[F.round(F.col(f"ratio{m}") * SCALE).cast("long") for m in models]).alias("ratio"))
    model = UrlModel(checkpointed(counted.select("g", "n").join(ratios, "g")), 0.0)
    own = F.when(F.col("verdict").isNull(), 0).otherwise(fold_of(F.col("url")) + 1)
    scores = checkpointed(judged.join(model.scored(judged, own), "url"))
    bins = scores.where("verdict is not null").select("verdict", "n", F.floor(F.least(F.greatest(F.col("url_score"), F.lit(-10.0)), F.lit(10.0)) * 100).alias("at")).groupBy("at").agg(F.sum(F.when(F.col("verdict") == "allow", F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("verdict") == "block", F.col("n")).otherwise(0)).alias("b")).orderBy("at").collect()  # 2001 bins at most
    allowed, blocked = sum(r["a"] for r in bins), sum(r["b"] for r in bins)
    if allowed and blocked:
        best, kept, gone, last = -1.0, allowed, 0, None
        for r in bins:
            if (right := kept / allowed + gone / blocked) > best:
                best, model.threshold = right, (r["at"] * 2 if last is None else r["at"] + last + 1) / 200
            kept, gone, last = kept - r["a"], gone + r["b"], r["at"]
    return model, scores


def filtered(pages: DataFrame, url: str = "url", rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """pages with host, path, rule, verdict and url_score (null where a rule decides); every row stays, columns of these
    names are replaced.

    Null and empty URLs and those without `://` have an empty host and path, fit no rule and are judged as they are.
    Repeated rows get equal values. Counts come from all rows; each distinct URL is scored once, by the ratios of all
    strings that were seen, however many.
    """
    host, path = parts(F.col(url))
    known = pages.withColumn("host", host).withColumn("path", path)
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    known = known.withColumn("rule", rule).withColumn("verdict", verdict)
    judged = checkpointed(known.select(F.coalesce(F.col(url), F.lit("")).alias("url"), "verdict").groupBy("url", "verdict").agg(F.count("*").alias("n")))
    model, scores = fit(judged)
    key = next(f"_url{k}" for k in range(len(pages.columns) + 1) if f"_url{k}" not in pages.columns)
    open_ = known.where("verdict is null").withColumn(key, F.coalesce(F.col(url), F.lit("")))
    open_ = looked_up(open_.drop("url_score"), scores.where("verdict is null").select(F.col("url").alias(key), "n", "url_score"), key, "url_score").drop(key)
    open_ = open_.withColumn("verdict", F.when(F.col("url_score") >= model.threshold, "allow").otherwise("block"))
    return known.where("verdict is not null").withColumn("url_score", F.lit(None).cast("double")).unionByName(open_)


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on every page's URL (null, empty and repeated ones: see filtered)."""
    return filtered(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "url_score")


def verdicts_sql(rules: tuple[tuple[str, str], ...] = RULES) -> str:
    """op9_urls in DuckDB SQL, by its definition: every level of contexts in turn, then the best of all thresholds."""
    first = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    fits = lambda own, rest: f"(host = '{own}' or ends_with(host, '.{own}')) and starts_with(path, '/{rest}')"
    rule, verdict = (f"case {' '.join(f'when {fits(*name.split(chr(47), 1))} then {chr(39)}{x}{chr(39)}' for says, name in first for x in [says if k else name])} end" for k in (0, 1))
    form = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    each = lambda f, join=", ": join.join(f(m) for m in ("", *HELD))
    levels = f"""l0 as (select c as g, {each(lambda m: f"(a{m} + 1::double) / (sum(a{m}) over () + count(*) over ()) as pa{m}, (b{m} + 1::double) / (sum(b{m}) over () + count(*) over ()) as pb{m}")}
  from (select right(g, 1) as c, {each(lambda m: f"sum(allowed{m})::bigint as a{m}, sum(blocked{m})::bigint as b{m}")} from counted group by 1))"""
    for k in range(1, ORDER + 1):
        levels += f""",
l{k} as (select x.g, {each(lambda m: f"(a{m} + {BACK_OFF}::double * pa{m}) / (na{m} + {BACK_OFF}::double) as pa{m}, (b{m} + {BACK_OFF}::double * pb{m}) / (nb{m} + {BACK_OFF}::double) as pb{m}")}
  from (select g, {each(lambda m: f"a{m}, b{m}, sum(a{m}) over (partition by left(g, {k})) as na{m}, sum(b{m}) over (partition by left(g, {k})) as nb{m}")}
    from (select right(g, {k + 1}) as g, {each(lambda m: f"sum(allowed{m})::bigint as a{m}, sum(blocked{m})::bigint as b{m}")} from counted group by 1)) x join l{k - 1} y on right(x.g, {k}) = y.g)"""
    ratio = lambda m: f"sum(round((ln(pa{m}) - ln(pb{m})) * {SCALE})::bigint)::double / (count(*) * {SCALE}::double)"
    score = f"case when any_value(verdict) is null then {ratio('')} " + " ".join(f"when any_value(fold) = {k} then {ratio(m)}" for k, m in enumerate(HELD)) + " end"
    held = "".join(f", sum(case when verdict = '{v}' and fold <> {k} then n else 0 end) as {name}_{k}" for k in range(FOLDS) for v, name in (("allow", "allowed"), ("block", "blocked")))
    return f"""with parted as (select page_id, coalesce(url, '') as url, translate(coalesce(regexp_extract(url, '{form}', 1), ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') as host, coalesce(regexp_extract(url, '{form}', 2), '') as path from pages),
ruled as (select *, {rule} as rule, {verdict} as verdict from parted),
judged as (select url, verdict, count(*) as n, (strpos('0123456789abcdef', left(md5(url), 1)) - 1) % {FOLDS} as fold from ruled group by 1, 2),
seen as (select *, substr(repeat(chr(2), {ORDER}) || url || chr(3), i, {ORDER + 1}) as g from (select *, unnest(range(1, length(url) + 2)) as i from judged)),
counted as (select g, sum(case when verdict = 'allow' then n else 0 end) as allowed, sum(case when verdict = 'block' then n else 0 end) as blocked{held} from seen group by 1),
{levels},
scores as (select url, any_value(verdict) as verdict, any_value(n) as n, {score} as score from seen join l{ORDER} using (g) group by url),
bins as (select floor(least(greatest(score, -10), 10) * 100) as cell, sum(case when verdict = 'allow' then n else 0 end)::double as a, sum(case when verdict = 'block' then n else 0 end)::double as b from scores where verdict is not null group by 1),
tried as (select cell, lag(cell) over (order by cell) as last, sum(a) over () as all_a, sum(b) over () as all_b, sum(a) over (order by cell rows between current row and unbounded following) as kept, coalesce(sum(b) over (order by cell rows between unbounded preceding and 1 preceding), 0) as gone from bins),
chosen as (select coalesce((select case when last is null then cell * 2 else cell + last + 1 end / 200 from tried where all_a > 0 and all_b > 0 order by kept / all_a + gone / all_b desc, cell limit 1), 0) as threshold)
select page_id, host, path, rule, coalesce(r.verdict, case when score >= threshold then 'allow' else 'block' end) as verdict, case when r.verdict is null then score end as url_score
from ruled r join scores s on r.url = s.url cross join chosen"""
