"""URL filters: rules by host and path, and for the rest trust along links between hosts.

Trust starts at the hosts whose pages rules allow and runs along links
(personalised PageRank); distrust starts at those whose pages rules block and
runs against links. A page that no rule fits gets the verdict of its host:
block where distrust is above BLOCK_RATIO times trust and above BLOCK_LEAST of
what a wholly blocked host starts with, else allow.

Host: after the first :// up to / ? # or the end, A-Z in lower case; path: from there up
to ? # or the end. A null url, or one without ://, has an empty host and path.
Links are read from a and area elements outside comments, scripts and the like, as a browser would: only the attribute
href counts, with its character references decoded and blanks around it gone. A link that begins with // takes its
page's scheme; others that are not absolute http(s) ones stay on their host and count for nothing. Links that repeat count as often
as they stand; scores are within SETTLED of their limits. Rows that repeat weigh a host's
seed and links alike and stay, each with its verdict; of rules as long as each other
(which no page fits both) none comes first. A long page or url is matched as a whole. No
rows give none; columns of any other name play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import copied, cut, dealt, hot_keys

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DAMPING = 0.85
#: A guard only: what moves shrinks by DAMPING in each round, so that no table of hosts comes near it.
MOST_ROUNDS = 400
#: Scores are settled once no host, whatever links to it, can still gain more than this.
SETTLED = 1e-6
BLOCK_RATIO, BLOCK_LEAST = 2.0, 0.5
#: Parts into which the pages of a host are dealt for the last join.
SALTS = 64


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The longest rule that fits, as struct<size, verdict, rule>, or null; rules: a list of fixed size."""
    found = [
        F.when(
            (host == h) | host.endswith("." + h),
            F.when(path.startswith(p), F.struct(F.lit(len(h + p)).alias("size"), F.lit(v).alias("verdict"), F.lit(h + p).alias("rule"))),
        )
        for v, h, p in rules
    ]
    return F.array_max(F.array_compact(F.array(*found)))


#: What a page's links are read without: comments, and elements whose content is no markup.
UNREAD = r"(?is)<!--(?:-?>|.*?(?:--!?>|\z))|<(script|style|template|textarea|title|xmp|iframe|noembed|noframes)\b[^>]*>.*?(?:</\1\b[^>]*>|\z)"
#: Fixed values of HTML: named references of characters that hosts, schemes and their marks are written with.
NAMED = {"amp": "&", "sol": "/", "colon": ":", "period": ".", "hyphen": "-", "dash": "-", "lowbar": "_", "num": "#", "quest": "?", "commat": "@", "Tab": "\t", "NewLine": "\n", "nbsp": "\u00a0"}


def decoded(text: Column) -> Column:
    """text with its numeric character references and those of NAMED as characters."""
    pieces = F.split(text, "&", -1)

    def read(piece: Column) -> Column:
        number = F.regexp_extract(piece, r"^#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6})", 0)
        hexadecimal = F.lower(F.substring(number, 2, 1)) == "x"
        digits = F.when(hexadecimal, F.substring(number, 3, 6)).otherwise(F.substring(number, 2, 7))
        code = F.conv(digits, 10, 10).cast("int")
        code = F.when(hexadecimal, F.conv(digits, 16, 10).cast("int")).otherwise(code)
        able = (number != "") & code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        rest = F.regexp_replace(piece, r"^#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});?", "")
        out = F.when(able, F.concat(char, rest)).otherwise(F.concat(F.lit("&"), piece))
        for name, value in NAMED.items():
            out = F.when(piece.startswith(f"{name};"), F.concat(F.lit(value), F.substr(piece, F.lit(len(name) + 2)))).otherwise(out)
        return out

    whole = F.concat(F.element_at(pieces, 1), F.array_join(F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), read), ""))
    return F.when(F.contains(text, F.lit("&")), whole).otherwise(text)


def hrefs(html: Column) -> Column:
    """The targets of a page's links in its order, as browsers read them: array<string>.

    Each piece begins behind <a or <area. Quoted values of its other attributes go first, so that href in one of them counts for nothing.
    """
    markup = F.regexp_replace(F.coalesce(html, F.lit("")), UNREAD, "")
    pieces = F.split(markup, r"(?i)<(?:a|area)(?=[\s/])", -1)

    def target(piece: Column) -> Column:
        close = F.regexp_replace(piece, r"\s*=\s*", "=")
        bare = F.regexp_replace(close, r"""(?i)(?<![\s"'/]href)=(?:"[^"]*"|'[^']*')""", "= ")
        value = F.regexp_extract(bare, r"""(?i)^[^>]*?[\s"'/]href=("[^"]*"|'[^']*'|[^\s>"']+)""", 1)
        value = F.regexp_replace(value, r"""(?s)^(?:"(.*)"|'(.*)')$""", "$1$2")
        return F.regexp_replace(F.regexp_replace(decoded(value), r"[\t\n\r]", ""), r"^[\x00-\x20]+|[\x00-\x20]+$", "")

    return F.filter(F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), target), lambda t: t != "")


def links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts, from whole pages."""
    out = pages.where(F.col("html").rlike(r"(?i)<a(?:rea)?[\s/]")).select(host_of(F.col("url")).alias("src"), F.explode(hrefs(F.col("html"))).alias("href"))
    href = F.when(F.col("href").startswith("//"), F.concat(F.lit("http:"), "href")).otherwise(F.col("href"))
    absolute = out.where("src <> ''").select("src", href.alias("href")).where(F.col("href").rlike("(?i)^https?://"))
    return absolute.select("src", host_of(F.col("href")).alias("dst")).where("src <> dst and dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))


def spread(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(kind, host, score) after personalised PageRank; edges (kind, src, dst, n), seeds (kind, host, seed) by kind.

    The edges of a host that very many hosts link to are dealt over several parts, once for all rounds.
    """
    key = ["kind", "src"]
    out_of = cut(edges.groupBy(*key).agg(F.sum("n").alias("all"), F.count("*").alias("rows")))
    score = seeds.select("kind", "host", (F.col("seed") * (1 - DAMPING)).alias("score"))
    if out_of.isEmpty():  # no link leads anywhere: what starts at a host stays there
        return score
    hot = cut(hot_keys(out_of, key, "rows"))
    shares = dealt(edges, hot, key, F.xxhash64("dst")).join(copied(out_of.drop("rows"), hot, key), [*key, "_salt"])
    weighed = cut(shares.select(*key, "_salt", "dst", (F.col("n") / F.col("all")).alias("w")))
    # `moved` is what reached a host in the last round. All that is still to come, at all hosts together, is at most
    # DAMPING / (1 - DAMPING) of its sum, so that this holds for a host on which many small moves meet, too.
    score = cut(score.withColumn("moved", F.col("score")))
    for _ in range(MOST_ROUNDS):
        going = copied(score.where("moved > 0").select("kind", F.col("host").alias("src"), "moved"), hot, key)
        moved = weighed.join(going, [*key, "_salt"]).groupBy("kind", F.col("dst").alias("host")).agg((F.sum(F.col("w") * F.col("moved")) * DAMPING).alias("score"))
        both = score.select("kind", "host", "score", F.lit(0.0).alias("moved")).union(moved.select("kind", "host", "score", F.col("score").alias("moved")))
        score = cut(both.groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("moved").alias("moved")))
        if (score.agg(F.sum("moved")).first()[0] or 0.0) * DAMPING <= SETTLED * (1 - DAMPING):
            return score.drop("moved")
    raise RuntimeError(f"scores of hosts have not settled in {MOST_ROUNDS} rounds")


def host_verdicts(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """(host, verdict): what the links say of each host that has pages."""
    judged = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    verdict = best_rule(F.col("host"), F.col("path"), rules)["verdict"]
    hosts = judged.where("host <> ''").groupBy("host").agg(*(F.avg(F.coalesce((verdict == v).cast("double"), F.lit(0.0))).alias(v) for v in ("allow", "block")))
    hosts = cut(hosts)
    seeds = hosts.select("host", F.explode(F.array(*(F.struct(F.lit(v).alias("kind"), F.col(v).alias("seed")) for v in ("allow", "block")))).alias("s"))
    seeds = seeds.select("s.kind", "host", "s.seed").where("seed > 0")
    found = links(pages)
    edges = found.select(F.lit("allow").alias("kind"), "src", "dst", "n").union(found.select(F.lit("block").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))
    score = spread(edges, seeds).groupBy("host").agg(*(F.sum(F.when(F.col("kind") == v, F.col("score"))).alias(f"s_{v}") for v in ("allow", "block")))
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("s_allow", "s_block"))
    bad = (distrust > BLOCK_RATIO * trust) & (distrust > BLOCK_LEAST * (1 - DAMPING))
    return hosts.select("host").join(score, "host", "left").select("host", F.when(bad, "block").otherwise("allow").alias("verdict"))


def judge(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict for each row of pages."""
    url = F.col("url")
    own = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    own = own.withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    by_host = host_verdicts(pages.select("url", "html"), rules).withColumnRenamed("verdict", "of_host")
    # a host may hold a third of all pages: its pages are dealt over SALTS keys, and each host is repeated for them
    own = own.withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int"))
    by_host = by_host.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return own.join(by_host, ["host", "salt"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", "of_host", F.lit("allow")).alias("verdict")
    )
