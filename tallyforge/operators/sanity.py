"""Stage C: does a small model learn anything from the examples? Tokens and vocabularies are Spark relations; a model is
trained for each (dataset, config, seed) group on a bounded sample, many groups at a time."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.parsing import portable_hash

TOKEN = r"[0-9a-f]{8,}|[a-zA-Z]+|\d+|[^\sa-zA-Z\d]"
VOCABULARY = 500
PAD, UNKNOWN = 0, 1
MAX_TRAIN, MAX_VAL = 400, 200
#: Configurations of the grid: width of the model, epochs, learning rate.
CONFIGS = {"small": (16, 15, 0.1), "medium": (32, 25, 0.08), "large": (48, 35, 0.06)}


def tokens(text: Column) -> Column:
    """Lower-case tokens: long hexadecimal ids, words, numbers, other characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def vocabulary(texts: DataFrame, text: str = "text", most: int = VOCABULARY) -> DataFrame:
    """(token, id) of the most frequent tokens, of equals the first by name; 0 and 1 are for padding and unknowns."""
    counts = texts.select(F.explode(tokens(F.col(text))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), "token").limit(most - 2)
    return top.select("token", (F.row_number().over(Window.orderBy(F.desc("n"), "token")) + 1).alias("id"), "n")  # at most ``most`` rows


def encoded(texts: DataFrame, vocab: DataFrame, length: int = 48, text: str = "text") -> DataFrame:
    """``texts`` with ids: token numbers, cut or padded to ``length``."""
    table = vocab.agg(F.map_from_entries(F.collect_list(F.struct("token", F.col("id").cast("int")))).alias("_ids"))
    known = texts.join(F.broadcast(table), F.lit(True))  # one row of at most VOCABULARY entries
    ids = F.transform(F.slice(tokens(F.col(text)), 1, length), lambda t: F.coalesce(F.try_element_at("_ids", t), F.lit(UNKNOWN)))
    padded = known.withColumn("ids", F.coalesce(ids, F.array().cast("array<int>")))
    return padded.withColumn("ids", F.concat("ids", F.array_repeat(F.lit(PAD), F.lit(length) - F.size("ids")))).drop("_ids")


def sampled(examples: DataFrame, seed: int = 0, by: list[str] = (), most: dict[str, int] | None = None) -> DataFrame:
    """At most MAX_TRAIN rows of train and MAX_VAL of val (or ``most`` of each split) for each group: those of the smallest
    seeded hashes. The constant bound lets every task keep its own smallest rows before the shuffle, so a group of any size
    sends no more than that from each task."""
    most = most or {"train": MAX_TRAIN, "val": MAX_VAL}
    order = Window.partitionBy(*by, "split").orderBy(portable_hash(F.lit(seed), F.col("text"), F.col("output")), "text", "output")
    ranked = examples.filter(F.col("split").isin(list(most))).withColumn("_k", F.row_number().over(order)).filter(F.col("_k") <= max(most.values()))
    own = F.coalesce(*[F.when(F.col("split") == s, n) for s, n in most.items()])
    return ranked.filter(F.col("_k") <= own).drop("_k")


RUN_SCHEMA = (
    "dataset string, model_config string, seed int, train_examples int, val_examples int, num_classes int, random_baseline double, "
    "majority_baseline double, final_val_accuracy double, final_train_accuracy double, margin_over_majority double, history string, samples string"
)


class Classifier:
    """One attention layer with a single head over token embeddings, mean-pooled into a softmax."""

    def __init__(self, vocab: int, classes: int, length: int, width: int, seed: int):
        r = np.random.default_rng(seed)
        init = lambda *s: r.normal(0, 1 / np.sqrt(s[-1]), s)
        self.p = {"e": init(vocab, width), "pos": 0.1 * init(length, width), "q": init(width, width), "k": init(width, width), "v": init(width, width), "o": init(width, classes), "b": np.zeros(classes)}

    def forward(self, ids: np.ndarray):
        """``ids``: (batch, length). Class probabilities and what the gradient needs."""
        p, mask = self.p, (ids != PAD).astype(float)
        x = p["e"][ids] + p["pos"]
        q, k, v = x @ p["q"], x @ p["k"], x @ p["v"]
        s = q @ k.transpose(0, 2, 1) / np.sqrt(x.shape[2]) + (mask[:, None, :] - 1) * 1e9
        a = np.exp(s - s.max(axis=2, keepdims=True))
        a /= a.sum(axis=2, keepdims=True)
        h = x + a @ v
        share = mask / np.maximum(1, mask.sum(axis=1, keepdims=True))
        pooled = (h * share[:, :, None]).sum(axis=1)
        z = pooled @ p["o"] + p["b"]
        y = np.exp(z - z.max(axis=1, keepdims=True))
        return y / y.sum(axis=1, keepdims=True), (ids, x, q, k, v, a, share, pooled)

    def step(self, ids: np.ndarray, y: np.ndarray, rate: float) -> float:
        prob, (ids, x, q, k, v, a, share, pooled) = self.forward(ids)
        p, n, root = self.p, len(ids), np.sqrt(x.shape[2])
        loss = -np.log(np.maximum(1e-12, prob[np.arange(n), y])).mean()
        dz = prob.copy()
        dz[np.arange(n), y] -= 1
        dz /= n
        dh = (dz @ p["o"].T)[:, None, :] * share[:, :, None]
        da = dh @ v.transpose(0, 2, 1)
        ds = a * (da - (da * a).sum(axis=2, keepdims=True)) / root
        dq, dk, dv = ds @ k, ds.transpose(0, 2, 1) @ q, a.transpose(0, 2, 1) @ dh
        dx = dh + dq @ p["q"].T + dk @ p["k"].T + dv @ p["v"].T
        de = np.zeros_like(p["e"])
        np.add.at(de, ids, dx)
        flat = lambda t: t.reshape(-1, t.shape[2])
        grads = {"e": de, "pos": dx.sum(axis=0), "q": flat(x).T @ flat(dq), "k": flat(x).T @ flat(dk), "v": flat(x).T @ flat(dv), "o": pooled.T @ dz, "b": dz.sum(axis=0)}
        for name, g in grads.items():
            norm = np.linalg.norm(g)
            p[name] -= rate * g * min(1.0, 5.0 / max(norm, 1e-12))
        return float(loss)


def train_run(rows: pd.DataFrame, config: tuple[int, int, float], seed: int, batch: int = 16) -> dict:
    """Train on the split train of rows (ids, text, output, split), measure on val."""
    width, epochs, rate = config
    labels = sorted(rows["output"].unique())
    number = {x: i for i, x in enumerate(labels)}
    part = {s: rows[rows["split"] == s] for s in ("train", "val")}
    x = {s: np.array(d["ids"].tolist(), np.int64).reshape(len(d), -1) for s, d in part.items()}
    y = {s: d["output"].map(number).to_numpy(np.int64) for s, d in part.items()}
    model = Classifier(int(max((a.max(initial=1) for a in x.values()), default=1)) + 1, len(labels), max(1, x["train"].shape[1]), width, seed)
    right = lambda s: float((model.forward(x[s])[0].argmax(axis=1) == y[s]).mean()) if len(y[s]) else None

    def shown():
        if not len(y["val"]):
            return []
        prob = model.forward(x["val"][:5])[0]
        return [{"text": t, "true": o, "predicted": labels[int(q.argmax())], "confidence": round(float(q.max()), 3)} for t, o, q in zip(part["val"]["text"][:5], part["val"]["output"][:5], prob)]

    before, history, r = shown(), [], np.random.default_rng(seed)
    for epoch in range(epochs if len(y["train"]) else 0):
        order = r.permutation(len(y["train"]))
        losses = [model.step(x["train"][order[i : i + batch]], y["train"][order[i : i + batch]], rate * batch / 4) for i in range(0, len(order), batch)]
        history.append({"epoch": epoch + 1, "train_loss": float(np.mean(losses)), "train_accuracy": right("train"), "val_accuracy": right("val")})
    majority = part["train"]["output"].value_counts().sort_index().idxmax() if len(y["train"]) else None
    base = float((part["val"]["output"] == majority).mean()) if len(y["val"]) and majority is not None else None
    final = history[-1]["val_accuracy"] if history else None
    return {
        "train_examples": len(y["train"]), "val_examples": len(y["val"]), "num_classes": len(labels), "random_baseline": 1 / len(labels) if labels else None,
        "majority_baseline": base, "final_val_accuracy": final, "final_train_accuracy": history[-1]["train_accuracy"] if history else None,
        "margin_over_majority": final - base if final is not None and base is not None else None, "history": history, "samples": {"before": before, "after": shown()},
    }


def run_grid(examples: DataFrame, configs: dict = CONFIGS, seeds: tuple[int, ...] = (0, 1, 2), length: int = 48) -> DataFrame:
    """Rows (dataset, text, output, split) to one row for each dataset, config and seed. A group has at most
    MAX_TRAIN + MAX_VAL rows."""
    import json

    spark = examples.sparkSession
    some = sampled(examples, by=["dataset"])
    parts = encoded(some, vocabulary(some.filter("split = 'train'")), length)
    runs = spark.createDataFrame([(c, s) for c in configs for s in seeds], "model_config string, seed int")
    each = parts.join(F.broadcast(runs), F.lit(True))  # a few runs for each of the bounded samples

    def train(group: pd.DataFrame) -> pd.DataFrame:
        first = group.iloc[0]
        out = train_run(group.sort_values(["text", "output"]), configs[first["model_config"]], int(first["seed"]))
        out |= {k: json.dumps(out[k]) for k in ("history", "samples")}
        return pd.DataFrame([{"dataset": first["dataset"], "model_config": first["model_config"], "seed": int(first["seed"]), **out}])

    return each.groupBy("dataset", "model_config", "seed").applyInPandas(train, RUN_SCHEMA)
