"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses and each word becomes a symbol: insult, threat,
target, negation, report, or other. Five transducers over these symbols, with
weights that multiply along a path and add up over paths, are composed into one
when the module is read: CHOICE marks one insult or threat of the clause on each
path, MENACE asks for the target of a marked threat, AIM raises a marked insult
that has a target, DENIAL lowers what follows a negation, and REPORT what someone
else is said to say, be that before or after. A clause's weight is the sum over
the accepted paths, that of a path being the marked word's own weight and the
weights of its arcs. A text's figures are its strongest clause and the sum over
its matched clauses; a logistic curve turns them into a score.

The words of four classes are fixed lists. Insults are those of a short list and
the words and word beginnings that a bounded sample of labelled rows shows to
belong to toxic texts; from the same sample comes the curve. Labels serve from
rows of the training folds only.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import as_bytes, own_name, small_batches, stage

#: Most labelled rows that training reads: those of least hash.
SAMPLE = 12_000
#: Evidence in bits that a learned insult needs, and the share of its rows that are toxic. How many there are follows from the sample.
BITS = 12
PURITY = 0.9
BEGINNINGS = (4, 5, 6, 7)
CUT = 0.7
FOLDS = 3
HELD_OUT = 1

#: Fixed word lists, in English, German, French and Spanish.
INSULTS = """
idiot moron stupid dumb fool loser scum trash clown pathetic worthless disgusting imbecile jerk bastard filth vermin
dumm idiotin trottel abschaum arschloch versager widerlich müll
imbécile stupide crétin ordure connard minable nul débile
idiota estúpido estúpida imbécil basura inútil payaso asqueroso
""".split()
THREATS = """
kill hurt destroy beat murder shoot stab crush burn
töten umbringen vernichten schlagen erschießen
tuer frapper détruire massacrer
matar golpear destruir quemar
""".split()
TARGETS = "you your yourself u ya du dich dir ihr euch tu toi te vous ti usted ustedes tú".split()
NEGATIONS = "not no never isn't aren't don't without nicht kein keine nie pas jamais aucun nunca jamás".split()
REPORTS = "said says wrote writes quoted called claims claimed reported sagte schrieb dit écrit dijo escribió".split()

#: Fixed weights of the grammar.
SEED_WEIGHT = 3.0
THREAT_WEIGHT = 3.0
NEGATED = 0.3
REPORTED = 0.5
TARGETED = 1.5
REACH = 3
_MARKS = ".,;:!?()[]{}\"'«»“”„…-*_#|/~+=<>&@%$^`"
_ENDS = (".", "!", "?", ";", ":")
MEMO = 500_000


CLASSES = ("insult", "threat", "target", "negation", "report", "other")


@dataclass(frozen=True)
class Transducer:
    """arcs[state, symbol] are the (symbol written, weight, next state) that can be taken; finals are the accepting states; it starts in `start`."""

    arcs: dict
    finals: frozenset
    start: object = 0


def _machine(symbols: tuple[str, ...], states: int, finals: set[int], arcs: dict) -> Transducer:
    """A machine whose states stay, with weight one, on symbols that have no arc; arcs[state, symbol] is (weight, next state)."""
    every = {(s, x): [(x, *arcs.get((s, x), (1.0, s)))] for s in range(states) for x in symbols}
    return Transducer(every, frozenset(finals))


def compose(a: Transducer, b: Transducer) -> Transducer:
    """The transducer that gives b what a writes: states are pairs, weights multiply."""
    symbols = sorted({x for _, x in a.arcs})
    start, arcs, finals = (a.start, b.start), {}, set()
    front, seen = [start], {start}
    while front:
        p, q = front.pop()
        if p in a.finals and q in b.finals:
            finals.add((p, q))
        for x in symbols:
            arcs[(p, q), x] = out = [(z, v * w, (m, n)) for y, v, m in a.arcs.get((p, x), []) for z, w, n in b.arcs.get((q, y), [])]
            new = {n for _, _, n in out} - seen
            seen |= new
            front += new
    return Transducer(arcs, frozenset(finals), start)


_MARKED = (*CLASSES, "insult!", "threat!")
_EITHER = ("insult!", "threat!")
CHOICE = Transducer(
    {(s, x): [(x, 1.0, s)] + ([(x + "!", 1.0, 1)] if s == 0 and x in ("insult", "threat") else []) for s in (0, 1) for x in CLASSES}, frozenset({1}))
MENACE = _machine(_MARKED, 2, {0}, {(0, "threat!"): (1.0, 1), (1, "target"): (1.0, 0)})
AIM = _machine(_MARKED, 4, {0, 1, 2, 3}, {
    (0, "target"): (1.0, 1), (0, "insult!"): (1.0, 2), (1, "insult!"): (TARGETED, 3), (2, "target"): (TARGETED, 3),
    (0, "threat!"): (1.0, 3), (1, "threat!"): (1.0, 3)})
DENIAL = _machine(_MARKED, REACH + 1, set(range(REACH + 1)), {
    (s, x): (NEGATED if s and x in _EITHER else 1.0, REACH if x == "negation" else max(0, s - 1)) for s in range(REACH + 1) for x in _MARKED})
REPORT = _machine(_MARKED, 4, {0, 1, 2, 3}, {
    (0, "report"): (1.0, 1), **{(0, x): (1.0, 2) for x in _EITHER}, **{(1, x): (REPORTED, 3) for x in _EITHER}, (2, "report"): (REPORTED, 3)})


def _table(whole: Transducer) -> tuple[list[dict[str, list[tuple[int, float, bool]]]], list[bool]]:
    """The composed transducer with numbered states: for each the arcs (next, weight, marks the word), and whether it accepts; 0 starts."""
    number = {whole.start: 0}
    for state, _ in whole.arcs:
        number.setdefault(state, len(number))
    moves: list[dict] = [{} for _ in number]
    for (state, x), out in whole.arcs.items():
        moves[number[state]][x] = [(number[n], w, y.endswith("!")) for y, w, n in out]
    return moves, [state in whole.finals for state in number]


MOVES, ACCEPTS = _table(compose(compose(compose(compose(CHOICE, MENACE), AIM), DENIAL), REPORT))


def clause_weight(symbols: list[tuple[str, float]]) -> float:
    """The sum over the composed transducer's accepted paths of a clause's (symbol, weight)."""
    now = {0: 1.0}
    for symbol, weight in symbols:
        after: dict[int, float] = {}
        for state, w in now.items():
            for to, factor, marks in MOVES[state][symbol]:
                after[to] = after.get(to, 0.0) + w * factor * (weight if marks else 1.0)
        now = after
    return sum(w for state, w in now.items() if ACCEPTS[state])


class Grammar:
    """Scores texts; terms are learned insults (beginnings end in *), curve the three logistic coefficients."""

    def __init__(self, terms: dict[str, float], curve: tuple[float, float, float] = (-4.0, 1.2, 0.5)):
        self.curve = curve
        self.begins = {t[:-1]: w for t, w in terms.items() if t.endswith("*")}
        self.classes: dict[str, tuple[str, float]] = {t: ("insult", w) for t, w in terms.items() if not t.endswith("*")}
        for t in INSULTS:
            self.classes.setdefault(t, ("insult", SEED_WEIGHT))
        for name, words in (("threat", THREATS), ("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS)):
            self.classes.update(dict.fromkeys(words, (name, THREAT_WEIGHT if name == "threat" else 1.0)))
        self.memo: dict[bytes, tuple[str, float, bool] | None] = {}

    def _symbol(self, raw: bytes) -> tuple[str, float, bool] | None:
        """Class, weight and whether a clause ends here; None for other words that end none."""
        word = raw.decode("utf-8", "replace").lower()
        ends = word.endswith(_ENDS)
        bare = word.strip(_MARKS)
        found = self.classes.get(bare)
        if self.begins and (found is None or found[0] == "insult"):
            weight = max((self.begins.get(bare[:n], 0.0) for n in BEGINNINGS if len(bare) >= n), default=0.0)
            if weight > (found[1] if found else 0.0):
                found = ("insult", weight)
        if found is None:
            found = ("other", 0.0)
            if not ends:
                return None
        return (*found, ends)

    def figures(self, text: bytes) -> tuple[float, float]:
        """Weight of the strongest clause, and of all clauses."""
        memo = self.memo
        words = text.split()
        if len(memo) > MEMO:
            memo.clear()
        for w in words:
            if w not in memo:
                memo[w] = self._symbol(w)
        symbols = [memo[w] for w in words]
        if not any(s and s[0] in ("insult", "threat") for s in symbols):
            return 0.0, 0.0
        most = total = 0.0
        clause: list[tuple[str, float]] = []
        for s in [*symbols, ("other", 0.0, True)]:
            clause.append((s[0], s[1]) if s else ("other", 0.0))
            if s and s[2]:
                if any(x in ("insult", "threat") for x, _ in clause):
                    weight = clause_weight(clause)
                    most, total = max(most, weight), total + weight
                clause = []
        return most, total

    def score(self, most: np.ndarray, total: np.ndarray) -> np.ndarray:
        a, b, c = self.curve
        return 1 / (1 + np.exp(-np.clip(a + b * most + c * np.log1p(total), -30, 30)))


def fold(doc_id: Column) -> Column:
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS).cast("int")


def _terms(text: bytes) -> set[str]:
    words = {w.strip(_MARKS) for w in text.decode("utf-8", "replace").lower().split()}
    words.discard("")
    return words | {w[:n] + "*" for w in words for n in BEGINNINGS if len(w) >= n}


def _shortest(terms: dict[str, float]) -> dict[str, float]:
    """The terms without those that begin with another one's beginning of no less weight: a word takes the most that fits."""
    covered = lambda t, w: any(terms.get(t[:n] + "*", -1.0) >= w for n in BEGINNINGS if n < len(t.rstrip("*")))
    return {t: w for t, w in terms.items() if not covered(t, w)}


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton's method, with a small ridge; coefficients of weights are not negative."""
    rows = np.column_stack([np.ones(len(x)), x])
    w = np.array([-4.0, 1.2, 0.5])
    ridge = np.diag([1e-3, 0.05, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        gradient = rows.T @ (y - p) - ridge @ w
        hessian = (rows * (p * (1 - p))[:, None]).T @ rows + ridge
        step = np.linalg.solve(hessian, gradient)
        w = w + step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(max(0.0, w[1])), float(max(0.0, w[2]))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Grammar:
    """A grammar from the labelled rows outside the held-out fold; from at most `sample` of them, those of least hash.

    The sample's ids and labels are broadcast, their number being bounded; terms
    are counted in parallel, and those that enough of the sample's toxic rows hold
    come to the driver, without the ones that a shorter beginning covers. A doc_id
    with several labels counts as toxic if one of them says so. Without a toxic
    and a clean row, the fixed lists and the default curve stand.
    """
    small_batches(docs.sparkSession)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = stage(known.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample))
    counts = {r.toxic: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    if not toxic or not clean:
        return Grammar({})
    rows = stage(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic"))

    def count(batches):
        for batch in batches:
            both: tuple[Counter, Counter] = (Counter(), Counter())
            for text, y in zip(as_bytes(batch.column("text")), batch.column("toxic").to_pylist(), strict=True):
                both[y == 1].update(_terms(text))
            terms = list(both[0].keys() | both[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in both)], ["term", "clean", "toxic"])

    seen = rows.mapInArrow(count, "term string, clean long, toxic long").groupBy("term").agg(
        F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    t, c, base = F.col("t"), F.col("c"), toxic / (toxic + clean)
    pure = t / (t + c)
    bits = t * F.log2(pure / base) + F.when(c > 0, c * F.log2((1 - pure) / (1 - base))).otherwise(0.0)
    weight = F.log((t + 0.5) / (toxic + 1)) - F.log((c + 0.5) / (clean + 1))
    good = seen.where((t > 0) & (pure >= PURITY)).where(bits >= BITS)
    grammar = Grammar(_shortest({r.term: round(r.w, 6) for r in good.select("term", weight.alias("w")).collect()}))

    def measure(batches):
        for batch in batches:
            f = [grammar.figures(x) for x in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([m for m, _ in f], pa.float64()), pa.array([s for _, s in f], pa.float64()), batch.column("toxic")], ["most", "total", "toxic"])

    figures = rows.mapInArrow(measure, "most double, total double, toxic int")
    same = figures.groupBy(F.round("most", 3).alias("most"), F.round("total", 3).alias("total"), "toxic").count()
    table = np.array([(r.most, np.log1p(r.total), r.toxic, r["count"]) for r in same.orderBy("most", "total", "toxic").collect()])
    many = np.repeat(table, table[:, 3].astype(int), axis=0)
    grammar.curve = tuple(round(v, 9) for v in _fit(many[:, :2], many[:, 2] == 1))
    return grammar


def score(docs: DataFrame, grammar: Grammar, keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """The columns `keep` of docs (by default doc_id) with the score, between 0 and 1, in a column of the given name.

    Null and empty texts score as texts without matches. Every row is scored by
    itself, so repeated rows get equal scores; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    keep = ["doc_id"] if keep is None else keep
    schema = docs.select(*keep).schema.add(name, "double")

    def rate(batches):
        for batch in batches:
            f = np.array([grammar.figures(x) for x in as_bytes(batch.column("text"))]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(grammar.score(f[:, 0], f[:, 1]))], [*keep, name])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(rate, schema)


def without_toxic(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """docs without the rows that score `cut` or more; same columns, whatever their names."""
    name = own_name(docs.columns, "score")
    return score(docs, train(docs, labels), docs.columns, name).where(F.col(name) < cut).select(*docs.columns)
