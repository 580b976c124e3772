"""Toxicity by a weighted grammar of clauses, its words and weights learned from labels."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import identity, text_or_empty
from driftline.session import stored

# General words of four languages by their part in a clause.
INSULTS = "idiot moron fool scum loser trash stupid pathetic worthless disgusting dumm trottel abschaum wertlos stupide crétin ordure pathétique estúpido basura escoria patético".split()
THREATS = "kill hurt destroy beat shoot töten schlagen zerstören tuer frapper détruire matar golpear destruir".split()
TARGETS = "you your yours he she they him her them du dich dein ihr euch sie tu te toi ton vous votre tú ti tu usted ustedes ellos".split()
NEGATIONS = "not no never isn't aren't don't nicht kein keine nie pas jamais aucun nunca jamás ninguno".split()
REPORTS = "said says called wrote claims quoted sagte nannte schrieb behauptet dit écrit appelé prétend dijo escribió llamó".split()

CLAUSE = re.compile(r"[.!?;:\n]+")
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
STEM = range(3, 9)
# Words that a negation, a target and a verb of saying reach.
REACH, AIM, REPORTED = 3, 8, 8
PATTERNS = ("insult", "insult_target", "threat", "threat_target", "negated", "reported")
HOSTILE = PATTERNS[:4]
FEATURES = len(PATTERNS) + 2
CACHED = 200_000


@dataclass
class Lexicon:
    """What feeds the machines: words to symbols with weights.

    `words` are whole words and `stems` beginnings of words, both of lower-case letters.
    """

    words: dict[str, tuple[str, float]] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)

    @staticmethod
    def general() -> Lexicon:
        symbols = {"target": TARGETS, "negation": NEGATIONS, "report": REPORTS, "threat": THREATS, "insult": INSULTS}
        return Lexicon({w: (symbol, 1.0) for symbol, words in symbols.items() for w in words})

    def read(self, word: str) -> tuple[str, float] | None:
        if word in self.words:
            return self.words[word]
        best = max((self.stems[word[:k]] for k in STEM if word[:k] in self.stems), default=0.0)
        return ("insult", best) if best else None


SYMBOLS = ("other", "insult", "threat", "target", "negation", "report")


@dataclass(frozen=True)
class Transducer:
    """States and symbols to the next state and what is put out, as a table. State `start` is where a clause begins."""

    start: object
    table: dict[tuple[object, str], tuple[object, object]]

    @staticmethod
    def of(start: object, step: Callable[[object, str], tuple[object, object]]) -> Transducer:
        """The table of all states that are reached from the start."""
        table, todo = {}, [start]
        while todo:
            state = todo.pop()
            for symbol in SYMBOLS:
                if (state, symbol) not in table:
                    table[state, symbol] = step(state, symbol)
                    todo.append(table[state, symbol][0])
        return Transducer(start, table)


def compose(*machines: Transducer) -> Transducer:
    """One machine that runs them side by side: its state and output are those of all, and only states that are reached are kept."""

    def step(state: tuple, symbol: str) -> tuple[tuple, tuple]:
        taken = [m.table[s, symbol] for m, s in zip(machines, state, strict=True)]
        return tuple(t[0] for t in taken), tuple(t[1] for t in taken)

    return Transducer.of(tuple(m.start for m in machines), step)


def telling(symbol: str) -> Transducer:
    """Puts out whether the word itself is of the kind."""
    return Transducer.of(0, lambda state, x: (0, x == symbol))


def reaching(symbol: str, words: int) -> Transducer:
    """Puts out whether a word of the kind stands at most so many words before."""
    return Transducer.of(0, lambda state, x: (words if x == symbol else max(0, state - 1), state > 0))


def aiming(words: int) -> Transducer:
    """Puts out "before" if a target stands at most so many words before, "after" at a target that comes so soon after an insult or threat."""

    def step(state: tuple[int, int], x: str) -> tuple[tuple[int, int], str]:
        seen, pending = state
        out = "after" if x == "target" and pending else "before" if seen else ""
        return (words if x == "target" else max(0, seen - 1), words if x in ("insult", "threat") else max(0, pending - 1) * (x != "target")), out

    return Transducer.of((0, 0), step)


# Insult, threat, target, negation and reported speech, in this order.
CLAUSES = compose(telling("insult"), telling("threat"), aiming(AIM), reaching("negation", REACH), reaching("report", REPORTED))


def match_clause(symbols: list[tuple[str, float] | None]) -> list[tuple[str, float]]:
    """A clause's symbols to the patterns it has, with weights, by the composed machine.

    An insult or threat is one match: of what is reported, else negated, else aimed at somebody, else plain. A plain one becomes
    aimed when a target follows it soon.
    """
    state, found = CLAUSES.start, []
    for symbol in symbols:
        kind, weight = symbol or ("other", 0.0)
        state, (insult, threat, aim, negated, reported) = CLAUSES.table[state, kind]
        if insult or threat:
            pattern = "reported" if reported else "negated" if negated else f"{kind}_target" if aim else kind
            found.append((pattern, weight))
        elif aim == "after" and found and found[-1][0] in ("insult", "threat"):
            found[-1] = (f"{found[-1][0]}_target", found[-1][1])
    return found


class Grammar:
    """Words to symbols, and clauses of symbols to patterns, over whole texts; keeps the readings of words it has seen."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon = lexicon
        self.seen: dict[str, tuple[str, float] | None] = {}

    def symbol(self, word: str) -> tuple[str, float] | None:
        try:
            return self.seen[word]
        except KeyError:
            if len(self.seen) > CACHED:
                self.seen.clear()
            return self.seen.setdefault(word, self.lexicon.read(word))

    def features(self, text: str | None) -> np.ndarray:
        """Logarithms of each pattern's summed weights, of all hostile ones together, and of the number of matched clauses.

        The sum over all lets a pattern count that the labelled texts happen not to have.
        """
        sums, clauses = dict.fromkeys(PATTERNS, 0.0), 0
        text = (text or "").lower()
        hostile = {w for w in set(TOKEN.findall(text)) if (s := self.symbol(w)) and s[0] in ("insult", "threat")}
        if hostile:
            for clause in CLAUSE.split(text):
                found = match_clause([self.symbol(w) for w in TOKEN.findall(clause)])
                clauses += bool(found)
                for pattern, weight in found:
                    sums[pattern] += weight
        return np.log1p(np.array([*sums.values(), sum(sums[p] for p in HOSTILE), float(clauses)]))


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def score(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(features @ self.weights + self.bias, -30, 30))))


def _parts(text: str) -> set[str]:
    """A text's words, as `=word`, and the beginnings of its words."""
    parts = set()
    for word in set(TOKEN.findall(text.lower())):
        parts.add(f"={word}")
        parts.update(word[:k] for k in STEM if k <= len(word))
    return parts


def _count_parts(texts: DataFrame, among: frozenset[str] | None = None) -> DataFrame:
    """In how many texts each part occurs: `part`, `texts`."""
    shared = None if among is None else texts.sparkSession.sparkContext.broadcast(among)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if shared is None else shared.value
        for batch in batches:
            for text in batch.column("text"):
                parts = _parts(text.as_py() or "")
                yield pa.RecordBatch.from_arrays([pa.array(sorted(parts if wanted is None else parts & wanted), pa.string())], names=["part"])

    return texts.select("text").mapInArrow(work, "part string").groupBy("part").agg(F.count(F.lit(1)).alias("texts"))


def learn_lexicon(labelled: DataFrame, *, least_share: float = 0.01, least_texts: int = 3, least_odds: float = 20.0) -> Lexicon:
    """The general words and those words and stems that toxic texts have and others have not.

    `labelled` has `text` and `toxic`. A part counts if at least `least_texts` toxic texts and `least_share` of them
    have it, and its odds in toxic texts are `least_odds` times those in others. A text has some thousand parts,
    so some 100 000 parts at most pass the share and reach the driver. Of stems that say the same the shortest stays.
    """
    toxic, other = labelled.filter("toxic = 1"), labelled.filter("toxic = 0")
    n_toxic, n_other = toxic.count(), other.count()
    lexicon = Lexicon.general()
    enough = max(least_texts, least_share * n_toxic)
    often = {r["part"]: r["texts"] for r in _count_parts(toxic).filter(F.col("texts") >= enough).collect()}
    if not often or not n_other:
        return lexicon
    there = {r["part"]: r["texts"] for r in _count_parts(other, frozenset(often)).collect()}
    odds = {}
    for part, t in often.items():
        o = there.get(part, 0)
        ratio = (t + 0.5) / (n_toxic - t + 0.5) * (n_other - o + 0.5) / (o + 0.5)
        if ratio >= least_odds:
            odds[part] = float(np.log(ratio))
    for part, weight in odds.items():
        if part.startswith("="):
            # What a word does in the grammar goes before what it seems to say.
            if lexicon.words.get(part[1:], ("insult",))[0] == "insult":
                lexicon.words[part[1:]] = ("insult", weight)
        elif not any(part[:k] in odds and odds[part[:k]] >= weight - 0.5 for k in STEM if k < len(part)):
            lexicon.stems[part] = weight
    return lexicon


def _fit(features: np.ndarray, labels: np.ndarray, ridge: float = 0.1) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton's method."""
    x = np.hstack((features, np.ones((len(features), 1))))
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (labels - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _featured(docs: DataFrame, lexicon: Lexicon, text_col: str, model: Model | None = None) -> DataFrame:
    """The text replaced by `features`, or with a model by `score`."""
    others = [c for c in docs.columns if c != text_col and (model is None or c != "score")]
    schema = docs.select(*others, *([F.array(F.lit(0.0)).alias("features")] if model is None else [F.lit(0.0).alias("score")])).schema

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(lexicon)
        for batch in batches:
            found = [grammar.features(t.as_py()) for t in batch.column(text_col)]
            last = pa.array([f.tolist() for f in found], pa.list_(pa.float64())) if model is None else pa.array([model.score(f) for f in found], pa.float64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], last], names=schema.fieldNames())

    return docs.mapInArrow(work, schema)


def learn(labelled: DataFrame, *, most_rows: int = 20_000) -> Model:
    """Learn lexicon and pattern weights from `text`, `toxic` (0 or 1) rows, about `most_rows` of them at most.

    That bound is on labelled rows only, drawn by a hash of the text. Equal texts count once, as toxic if at least half of their
    labels say so, so reruns agree. A null text counts as empty; rows with another label or none are left out. Without both labels
    the general words are used with fixed weights.
    """
    h1, h2 = identity("text")
    rows = labelled.filter("toxic IN (0, 1)").select(text_or_empty().alias("text"), F.col("toxic").cast("int").alias("toxic"), h1.alias("h1"), h2.alias("h2"))
    count = rows.count()
    if count > most_rows:
        rows = rows.filter(F.pmod(F.xxhash64("h1", F.lit("toxicity")), F.lit(1 << 30)) < int((1 << 30) * most_rows / count))
    merged = rows.groupBy("h1", "h2").agg(F.first("text").alias("text"), (2 * F.sum("toxic") >= F.count(F.lit(1))).cast("int").alias("toxic"))
    rows = stored(merged.select("text", "toxic"), "labelled")
    lexicon = learn_lexicon(rows)
    found = _featured(rows, lexicon, "text").orderBy("toxic", "features").collect()
    labels = np.array([r["toxic"] for r in found], np.float64)
    if len(set(labels)) < 2:
        return Model(lexicon, np.full(FEATURES, 0.5), -1.5)
    weights, bias = _fit(np.array([r["features"] for r in found]), labels)
    return Model(lexicon, weights, bias)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The input's other columns, with `score` (0 to 1) in place of the text, and of a column of that name.

    Null and empty texts match nothing; very long texts are read whole, clause by clause; repeated rows have equal scores. An empty
    table gives no rows.
    """
    return _featured(docs, model.lexicon, text_col, model)


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The input's rows that score below `least`, unchanged, whatever their other columns. Repeated rows go or stay together."""
    schema = docs.schema

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(model.lexicon)
        for batch in batches:
            keep = [model.score(grammar.features(t.as_py())) < least for t in batch.column(text_col)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(work, schema)
