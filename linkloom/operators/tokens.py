"""Typed tokens of a record, their weights, and per-record totals.

Twelve token types, told by a letter:

  n name word              k its skeleton                 p first five letters of the name
  a address word           d number in the address        h number with the next word's skeleton
  x name word | addr word  b address bigram               f whole name
  m whole name | number    c whole name | address word    s skeleton of the name | number

One array of (type, token) is built per record inside the row; exploding it is the only growth, and
no token needs a shuffle until the weights do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_digits, let, skeleton, words_of

DF_CAP = 2000
GROUPS = {"name": "nkpf", "addr": "ab", "num": "dh", "cross": "x", "combo": "mcs"}
TYPES = "nkpadhxbfmcs"


def group_of(typ: Column) -> Column:
    out = F.lit(None).cast("string")
    for group, letters in GROUPS.items():
        out = F.when(typ.isin(*letters), F.lit(group)).otherwise(out)
    return out


def _typed(letter: str, tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.struct(F.lit(letter).alias("typ"), t.alias("token")))


def token_array(name: Column, addr: Column) -> Column:
    """array<struct<typ, token>> of a record, distinct."""

    def built(w: Column) -> Column:
        names, addrs = w["names"], w["addrs"]
        whole = F.array_join(names, "")
        named = F.filter(names, lambda t: F.length(t) >= 2)
        skeletons = F.transform(named, skeleton)
        whole_skeleton = F.array_join(F.filter(skeletons, lambda s: F.length(s) >= 2), "")
        numbers = F.array_distinct(F.filter(addrs, is_digits))
        plain = F.filter(addrs, lambda t: ~is_digits(t))
        long_addr = F.filter(plain, lambda t: F.length(t) >= 4)
        at = lambda i: F.get(addrs, i)
        following = F.transform(addrs, lambda t, i: F.struct(t.alias("t"), at(i + 1).alias("nxt")))
        with_next = F.filter(following, lambda p: p["nxt"].isNotNull())
        short = lambda c: F.when(F.length(whole) >= 3, c).otherwise(F.array().cast("array<string>"))
        return F.array_distinct(
            F.concat(
                _typed("n", named),
                _typed("k", F.filter(skeletons, lambda t: F.length(t) >= 3)),
                _typed("p", F.when(F.length(whole) >= 5, F.array(F.substring(whole, 1, 5))).otherwise(F.array().cast("array<string>"))),
                _typed("a", F.filter(plain, lambda t: F.length(t) >= 3)),
                _typed("d", F.filter(addrs, is_digits)),
                _typed("h", F.transform(F.filter(with_next, lambda p: is_digits(p["t"]) & ~is_digits(p["nxt"])), lambda p: F.concat(p["t"], F.lit("_"), F.substring(skeleton(p["nxt"]), 1, 3)))),
                _typed(
                    "x",
                    F.flatten(
                        F.transform(
                            F.slice(F.filter(names, lambda t: F.length(t) >= 3), 1, 5),
                            lambda n: F.transform(F.slice(long_addr, 1, 8), lambda a: F.concat(n, F.lit("|"), a)),
                        )
                    ),
                ),
                _typed("b", F.transform(with_next, lambda p: F.concat(p["t"], F.lit("_"), p["nxt"]))),
                _typed("f", short(F.array(whole))),
                _typed("m", short(F.transform(numbers, lambda d: F.concat(whole, F.lit("|"), d)))),
                _typed("c", short(F.transform(F.array_distinct(long_addr), lambda a: F.concat(whole, F.lit("|"), a)))),
                _typed("s", F.when(F.length(whole_skeleton) >= 1, F.transform(numbers, lambda d: F.concat(whole_skeleton, F.lit("|"), d))).otherwise(F.array().cast("array<string>"))),
            )
        )

    return let(F.struct(words_of(name).alias("names"), words_of(addr).alias("addrs")), built)


def typed_tokens(records: DataFrame) -> DataFrame:
    """idx, src, country_n, typ, token of records (idx, src, country_n, name_core, addr_core)."""
    exploded = records.select("idx", "src", "country_n", F.explode(token_array(F.col("name_core"), F.col("addr_core"))).alias("t"))
    return exploded.select("idx", "src", "country_n", "t.typ", "t.token")


def token_weights(tokens: DataFrame) -> DataFrame:
    """country_n, typ, token, df, n_country, w = ln(n_country) - ln(df); n_country counts records with a token."""
    df = tokens.groupBy("country_n", "typ", "token").agg(F.count(F.lit(1)).alias("df"))
    # one row a country
    n = tokens.groupBy("country_n").agg(F.countDistinct("idx").alias("n_country"))
    return df.join(F.broadcast(n), "country_n").withColumn("w", F.ln("n_country") - F.ln("df"))


def weighted_postings(tokens: DataFrame, weights: DataFrame, df_cap: int = DF_CAP) -> DataFrame:
    """Tokens with their weight and df; those above the cap are left out by definition of the index."""
    return tokens.join(weights.where(F.col("df") <= df_cap), ["country_n", "typ", "token"])


def token_totals(tokens: DataFrame, weights: DataFrame) -> DataFrame:
    """idx and the weight sum of each token group, over all tokens of a record."""
    w = tokens.join(weights, ["country_n", "typ", "token"]).withColumn("grp", group_of(F.col("typ")))
    sums = [F.round(F.sum(F.when(F.col("grp") == g, F.col("w")).otherwise(0.0)), 4).alias(f"t_{g}") for g in GROUPS]
    return w.groupBy("idx").agg(*sums)
