"""Mixing sources to target weights.

Token weights are raked (iterative proportional fitting) over cells of source, language and topic: sources get their
target shares, languages and topics the shares that they have in the sources used. The cells are few; the fit never
sees a document. A document's expected number of uses is its cell's weight, never above its source's limit. Whole uses
are drawn by these probabilities, calibrated as the draw goes on: inside a bucket of a source, from the largest document
to the smallest, each with a seeded random number of its own, and the probabilities of those left are scaled so that the
bucket still comes to its tokens. Every document has its chance; the smallest ones make up for what the large ones took.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from testimonia.sources.shared import written
from testimonia.llm.tokens import encode_texts
from testimonia.sources.tables import table

#: Documents of a source that are drawn together, about; a larger source is drawn in more buckets.
BUCKET = 20_000
MAX_CELLS = 100_000


def rake(cells: pd.DataFrame, targets: dict[str, float], caps: dict[str, float], rounds: int = 200) -> tuple[np.ndarray, float]:
    """Uses per token of each cell (source, lang, topic, tokens), and the total of tokens.

    Sources without tokens are left out and the other shares grow in proportion. The total is the largest at which
    every source can have its share within its cap. Sources are fitted last, so their shares hold; a cell at its cap
    passes the rest to the other cells of its source.
    """
    tok = cells.tokens.to_numpy(float)
    source = cells.source.to_numpy()
    cap = np.array([caps[s] for s in source], float)
    have = {s: tok[source == s].sum() for s in targets}
    live = {s: w for s, w in targets.items() if w > 0 and have[s] > 0 and caps[s] > 0}
    if not live:
        return np.zeros(len(cells)), 0.0
    share = {s: w / sum(live.values()) for s, w in live.items()}
    total = min(have[s] * caps[s] / share[s] for s in live)
    use = np.array([total * share[s] / have[s] if s in share else 0.0 for s in source])
    natural = tok.sum()
    margins = [(cells[c].to_numpy(), {v: tok[cells[c].to_numpy() == v].sum() / natural for v in cells[c].unique()}) for c in ("lang", "topic")]

    def fit_sources() -> None:
        for s in share:
            mine = source == s
            want = total * share[s]
            for _ in range(50):
                now = (use * tok)[mine].sum()
                free = mine & (use < cap * (1 - 1e-12))
                room = (use * tok)[free].sum()
                if abs(now - want) <= 1e-9 * want or room <= 0:
                    break
                use[free] = np.minimum(use[free] * max(0.0, (room + want - now) / room), cap[free])

    for _ in range(rounds):
        before = use.copy()
        for values, want in margins:
            for v, part in want.items():
                mine = values == v
                now = (use * tok)[mine].sum()
                if now > 0:
                    use[mine] = np.minimum(use[mine] * part * total / now, cap[mine])
        fit_sources()
        if np.abs(use - before).max() < 1e-9:
            break
    return use, total


def _whole_uses(use: np.ndarray, tokens: np.ndarray, cap: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Whole uses of documents in their order, drawn by probabilities that are calibrated to the tokens still wanted."""
    weight = use * tokens
    want, left = weight.sum(), np.append(np.cumsum(weight[::-1])[::-1], 0.0)
    out = np.zeros(len(use), np.int64)
    for i, (u, t, c, r) in enumerate(zip(use, tokens, cap, chance)):
        p = min(c, max(0.0, u * want / left[i])) if left[i] > 0 else 0.0
        low = np.floor(p)
        out[i] = n = int(low) + int(r < p - low)
        want -= n * t
    return out


def _draw(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Whole uses of the documents of one bucket, the largest first, so that the last remainder is small.

    A document larger than its whole bucket's tokens keeps its chance: where it is drawn, its source comes out above its
    target, and the shares reached say so.
    """
    pdf = pdf.sort_values(["tokens", "mark", "doc_id"], ascending=[False, True, True], kind="stable")
    use, tokens, cap = (pdf[c].to_numpy(float) for c in ("use", "tokens", "cap"))
    chance = pdf["mark"].to_numpy(np.int64).view(np.uint64) / 2.0**64
    return pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "tokens": pdf["tokens"], "n_uses": _whole_uses(use, tokens, cap, chance)})


def mix_sources(docs: DataFrame, targets: DataFrame, lang: str = "lang", topic: str = "document_type", seed: int = 17, **tokenizer) -> DataFrame:
    """(doc_id, source, tokens, n_uses) of each document of a source with a target; n_uses may be 0.

    ``docs``: doc_id, text, source, lang, topic. A text in several rows counts as one text: the row of the smallest
    doc_id stands for it, in all sources, so that no text is used above its source's max_repeats. Texts without tokens
    and rows without a target's source are left out; null languages and topics are values of their own. Repeated target
    rows count once; null shares and limits count as 0. Without targets or documents there are no rows. One ``seed`` gives
    one draw.
    """
    docs = docs.select("doc_id", "text", "source", F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.coalesce(F.col(topic), F.lit("")).alias("topic"))
    targets = targets.select("source", "target_share", "max_repeats").where("source is not null").distinct()
    aim = targets.limit(MAX_CELLS + 1).toPandas()  # one row per named source
    if len(aim) > MAX_CELLS or aim.source.duplicated().any():
        raise ValueError("a source has two targets, or there are too many targets")
    aim = aim.fillna({"target_share": 0.0, "max_repeats": 0})
    shares, caps = dict(zip(aim.source, aim.target_share)), dict(zip(aim.source, aim.max_repeats))
    used = docs.join(F.broadcast(targets.select("source")), "source", "left_semi")
    used = used.where("text <> ''").withColumn("print", F.sha2("text", 256))
    # one pass over the texts gives tokens and prints; the columns go along
    sized = encode_texts(used, keep=("source", "lang", "topic", "print"), **tokenizer).withColumn("tokens", F.size("ids")).drop("ids").where("tokens > 0")
    first = F.struct("doc_id", "source", "lang", "topic", "tokens")
    one = written(sized.groupBy("print").agg(F.min_by(first, "doc_id").alias("d")).select("d.*"), "sized")
    cells = one.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")).limit(MAX_CELLS + 1).toPandas()
    if len(cells) > MAX_CELLS:
        raise ValueError("too many cells of source, language and topic")
    cells = cells.sort_values(["source", "lang", "topic"], ignore_index=True)
    cells["use"], _ = rake(cells, shares, caps) if len(cells) else (np.zeros(0), 0.0)
    cells["cap"] = [float(caps[s]) for s in cells.source]
    n_of = cells.groupby("source")["n"].sum()
    cells["buckets"] = [int(-(-n_of[s] // BUCKET)) for s in cells.source]
    rows = list(cells[["source", "lang", "topic", "use", "cap", "buckets"]].itertuples(index=False, name=None))
    weights = docs.sparkSession.createDataFrame(rows, "source string, lang string, topic string, use double, cap double, buckets int")
    drawn = one.join(F.broadcast(weights), ["source", "lang", "topic"])  # one row per cell
    drawn = drawn.withColumn("mark", F.xxhash64("doc_id", F.lit(seed))).withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.lit(7)), "buckets"))
    return drawn.groupBy("source", "bucket").applyInPandas(_draw, "doc_id long, source string, tokens long, n_uses long")


def shares_reached(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target: target_share, max_repeats, n_docs, tokens, actual_share (0 for a source without documents), most_uses."""
    got = mixed.groupBy("source").agg(F.sum(F.col("tokens") * F.col("n_uses")).alias("tokens"), F.count(F.when(F.col("n_uses") > 0, 1)).alias("n_docs"), F.max("n_uses").alias("most_uses"))
    total = got.agg(F.sum("tokens").alias("total"))
    out = targets.select("source", "target_share", "max_repeats").where("source is not null").distinct().join(got, "source", "left").crossJoin(F.broadcast(total))  # one row
    nil = F.lit(0).cast("long")
    return out.select("source", "target_share", "max_repeats", F.coalesce("n_docs", nil).alias("n_docs"), F.coalesce("tokens", nil).alias("tokens"), F.coalesce("most_uses", nil).alias("most_uses"), F.coalesce(F.try_divide(F.col("tokens").cast("double"), F.col("total")), F.lit(0.0)).alias("actual_share"))


def _mix(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    targets = table(spark, directory, "mix_targets")
    return mix_sources(table(spark, directory, "documents"), targets), targets


def p9_mix(spark: SparkSession, directory: str) -> DataFrame:
    """The documents used, each with its number of uses."""
    return _mix(spark, directory)[0].where("n_uses > 0")


def p9_shares(spark: SparkSession, directory: str) -> DataFrame:
    """The share of all tokens that each target really reached."""
    return shares_reached(*_mix(spark, directory))
