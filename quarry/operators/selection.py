"""Greedy subset selection: one pick at a time, by quality, coverage deficit and novelty, less penalties.

A pass over the distributed pool returns the CANDIDATES rows whose score can be highest from now on, by an upper bound: as
picks are added, deficits and novelty only fall and penalties only rise, and a coverage score is at most its largest
group's gain. The driver picks among them as long as the best one's exact score is above the bound of all others; then
the next pass follows. The picks are those of the sequential rule, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import kept_table

WEIGHTS = {
    "quality": 0.3, "coverage": 0.5, "novelty": 0.2, "top_groups": 3, "novelty_start": 0.2, "redundancy_start": 0.3, "redundancy": 0.12, "repeat": 0.08,
    "soft_focus": 0.12, "soft_start": 0.52, "fail_risk": 0.7,
}
#: Rows that a pass over the pool returns, of which the driver picks as many as it can.
CANDIDATES = 1024
#: Scores within this of the best are ties, which quality and then record_id decide.
TIE = 1e-8


@dataclass
class Picks:
    """What the picks so far have changed: coverage per category, uses per burst, vectors and ids chosen."""

    covered: np.ndarray
    used: dict[str, int] = field(default_factory=dict)
    vectors: list[np.ndarray] = field(default_factory=list)
    ids: list = field(default_factory=list)

    def take(self, ident, burst: str, vector: np.ndarray, evidence: np.ndarray) -> None:
        self.ids.append(ident)
        self.vectors.append(vector)
        self.covered = self.covered + evidence
        if burst:
            self.used[burst] = self.used.get(burst, 0) + 1


@dataclass(frozen=True)
class Rule:
    """The score of a row given the picks so far."""

    member: np.ndarray
    weight: np.ndarray
    target: np.ndarray
    p: dict
    similar_before: bool

    def gains(self, evidence: np.ndarray, covered: np.ndarray) -> np.ndarray:
        """Each group's largest gain, largest group first."""
        deficit = np.where(self.target > 1e-6, np.maximum(self.target - covered, 0) / np.maximum(self.target, 1e-6), 0.0)
        gain = evidence * deficit * self.weight
        return -np.sort(-np.stack([gain[:, m].max(axis=1) for m in self.member], axis=1), axis=1)

    def coverage(self, evidence: np.ndarray, covered: np.ndarray) -> np.ndarray:
        best = self.gains(evidence, covered)[:, : self.p["top_groups"]]
        positive = best > 1e-6
        return np.where(positive, best, 0).sum(axis=1) / np.maximum(1, positive.sum(axis=1))

    def scores(self, pool: dict[str, np.ndarray], similar: np.ndarray, picks: Picks, bound: bool = False) -> np.ndarray:
        """The rows' scores now; with bound, what they can be at most from now on."""
        p = self.p
        first = not picks.ids and not self.similar_before
        novelty = np.clip((1 - similar) / max(1e-6, 1 - p["novelty_start"]), 0, 1)
        if first:
            novelty = np.full(len(similar), 1.0 if bound else 0.5)
        coverage = self.gains(pool["evidence"], picks.covered)[:, 0] if bound else self.coverage(pool["evidence"], picks.covered)
        redundant = p["redundancy"] * np.clip((similar - p["redundancy_start"]) / max(1e-6, 1 - p["redundancy_start"]), 0, 1) ** 2
        soft = p["soft_focus"] * np.clip((pool["focus_risk"] - p["soft_start"]) / max(1e-6, p["fail_risk"] - p["soft_start"]), 0, 1)
        uses = pool["uses"] + np.array([picks.used.get(b, 0) for b in pool["burst"]])
        repeat = p["repeat"] * np.where(pool["burst"] == "", 0, np.minimum(3, uses))
        total = p["quality"] * pool["quality"] + p["coverage"] * coverage + p["novelty"] * novelty
        return total - pool["penalty"] - redundant - soft - repeat


def _arrays(pdf: pd.DataFrame) -> dict[str, np.ndarray]:
    out = {c: pdf[c].fillna(0).to_numpy(float) for c in ("quality", "penalty", "focus_risk", "uses")}
    out |= {c: np.stack([np.asarray(x, float) for x in pdf[c]]) for c in ("vector", "evidence")}
    return out | {"burst": pdf["burst"].fillna("").to_numpy(object), "record_id": pdf["record_id"].to_numpy(), "similar": pdf["similar"].fillna(-1.0).to_numpy(float)}


def _best(pool: dict[str, np.ndarray], score: np.ndarray) -> int:
    ties = np.flatnonzero(score >= score.max() - TIE)
    return int(ties[np.lexsort((pool["record_id"][ties], -pool["quality"][ties]))[0]])


def rule_of(group_of: list[str], weight: list[float], targets: list[float], p: dict, similar_before: bool = False) -> Rule:
    member = np.array([[g == x for x in group_of] for g in sorted(set(group_of))])
    return Rule(member, np.array(weight) / max(1.0, max(weight)), np.array(targets), p, similar_before)


def coverage_scores(pool: DataFrame, rule: Rule) -> DataFrame:
    """(record_id, coverage) of rows (record_id, evidence) before any pick."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                e = np.stack([np.asarray(x, float) for x in pdf["evidence"]])
                yield pd.DataFrame({"record_id": pdf["record_id"], "coverage": rule.coverage(e, np.zeros(len(rule.target)))})

    return pool.select("record_id", "evidence").mapInPandas(run, f"record_id {dict(pool.dtypes)['record_id']}, coverage double")


def select_greedy(pool: DataFrame, group_of: list[str], weight: list[float], targets: list[float], picks: int, p: dict = WEIGHTS, candidates: int = CANDIDATES) -> DataFrame:
    """(record_id, pick): the picks in order, as many as the pool allows.

    pool: record_id, quality, penalty, vector, evidence (one per category), and if present burst, focus_risk, similar
    (largest similarity to what was chosen before; -1 or null: none) and uses (of its burst before); nulls count as none.
    """
    defaults = {"burst": F.lit(""), "focus_risk": F.lit(0.0), "similar": F.lit(-1.0), "uses": F.lit(0)}
    pool = pool.select("record_id", "quality", "penalty", "vector", "evidence", *[F.col(c) if c in pool.columns else d.alias(c) for c, d in defaults.items()])
    pool = kept_table(pool, "pool")
    facts = pool.agg(F.count("*").alias("n"), F.max("similar").alias("s")).first()
    rule = rule_of(group_of, weight, targets, p, facts["s"] is not None and facts["s"] > -0.5)
    state = Picks(np.zeros(len(rule.target)))
    picks = min(picks, facts["n"])
    wanted = candidates
    while len(state.ids) < picks:
        # where bounds lie so close that no pick is certain, the next pass returns more rows
        wanted = candidates if _take(state, rule, _candidates(pool, rule, state, wanted), wanted, picks) else 4 * wanted
    kind = dict(pool.dtypes)["record_id"]
    return pool.sparkSession.createDataFrame(list(zip(state.ids, range(1, picks + 1))), f"record_id {kind}, pick long")


def _candidates(pool: DataFrame, rule: Rule, state: Picks, candidates: int) -> pd.DataFrame:
    """The rows not picked whose scores can be highest, with `bound`: as many as asked for, and one."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            pdf = pdf[~pdf["record_id"].isin(state.ids)].copy()
            if not len(pdf):
                continue
            rows = _arrays(pdf)
            # vectors of this batch against all picks so far, so that nothing but the picks is kept from pass to pass
            if state.vectors:
                pdf["similar"] = np.maximum(rows["similar"], (rows["vector"] @ np.stack(state.vectors).T).max(axis=1))
                rows["similar"] = pdf["similar"].to_numpy(float)
            pdf["bound"] = rule.scores(rows, rows["similar"], state, bound=True)
            yield pdf.nlargest(candidates + 1, "bound", keep="first")

    fields = ", ".join(f"{c} {t}" for c, t in pool.dtypes if c != "similar")
    return pool.mapInPandas(run, f"{fields}, similar double, bound double").orderBy(F.desc("bound"), "record_id").limit(candidates + 1).toPandas()


def _take(state: Picks, rule: Rule, found: pd.DataFrame, candidates: int, picks: int) -> int:
    """Picks among the candidates while none of the other rows can be better; how many."""
    rest = found["bound"].iloc[candidates] if len(found) > candidates else -np.inf
    rows = _arrays(found)
    similar, left = rows["similar"], np.ones(len(found), bool)
    taken = 0
    while len(state.ids) < picks and left.any():
        score = np.where(left, rule.scores(rows, similar, state), -np.inf)
        if score.max() - TIE <= rest:
            break
        i = _best(rows, score)
        left[i] = False
        taken += 1
        state.take(rows["record_id"][i], rows["burst"][i], rows["vector"][i], rows["evidence"][i])
        similar = np.maximum(similar, rows["vector"] @ rows["vector"][i])
    return taken
