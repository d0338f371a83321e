"""Toxicity by a weighted finite-state pattern grammar.

A clause is a string of word classes. Small transducers rewrite it one after the other: negation marks
what stands in its scope, reported speech marks what someone else said, also after a colon or before
"he said", a target in the clause strengthens an insult or makes a threat of a violent verb, on either
side of it. Their composition runs over the clause, targets are looked for from both ends, and the score
of a text follows from the weights of its matched clauses.

The words of insult, and their weights, are learned from labelled texts, as whole words or as word
beginnings. Targets, negations, report verbs and verbs of violence are a lexicon that is given, by default the lists
of four languages below; ``fit`` takes another.

What the kinds of matches weigh is learned as shares of a plain insult, so kinds that the labels hold no
example of keep their place beside it. Whatever the labels say, a negated or reported insult weighs less than a
plain one, one with a target no less, and a threat against a target makes at least one half.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from monthwise.llm.common import labelled_ids, labelled_texts, one_text_each, whole

TARGETS = (
    "you your yours u he she they him them du dich dir dein deine ihr euch euer sie ihn tu toi te "
    "ton ta tes vous votre vos il elle ils tú ti tus usted ustedes vosotros él ella ellos"
).split()
NEGATIONS = (
    "not no never neither nor isn't aren't wasn't don't doesn't nobody nicht nie niemals kein keine "
    "keinen niemand pas jamais aucun aucune personne nunca jamás ningún ninguna nadie"
).split()
REPORTS = (
    "said says say called calls claimed wrote quoted reported sagte sagt nannte schrieb behauptete "
    "dit disait appelé écrit prétend dijo dice llamó escribió afirmó"
).split()
THREATS = (
    "kill hurt destroy beat stab burn shoot umbringen töten schlagen vernichten tuer frapper détruire "
    "brûler matar golpear destruir quemar"
).split()
CLAUSE_END = re.compile(r"[.;:!?\n|]+")
WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
QUOTATION = re.compile(r'"[^"\n]*"|“[^“”\n]*”|„[^„“”\n]*[“”]|«[^«»\n]*»')
#: Words that can't be who said something.
NO_SPEAKER = "you u du ihr tu vous tú usted".split()


@dataclass(frozen=True)
class Lexicon:
    """Lower-case words of the classes that are given. ``no_speakers`` can't be who said something."""

    targets: tuple[str, ...] = tuple(TARGETS)
    negations: tuple[str, ...] = tuple(NEGATIONS)
    reports: tuple[str, ...] = tuple(REPORTS)
    threats: tuple[str, ...] = tuple(THREATS)
    no_speakers: tuple[str, ...] = tuple(NO_SPEAKER)

    @cached_property
    def classes(self) -> dict[str, str]:
        return {
            **dict.fromkeys(self.targets, "target"), **dict.fromkeys(self.negations, "not"),
            **dict.fromkeys(self.reports, "said"), **dict.fromkeys(self.threats, "threat"), "": "quote",
        }

    @cached_property
    def said(self) -> frozenset[str]:
        return frozenset(self.reports)

    @cached_property
    def _speaker(self) -> str:
        """Who said it, after the quotation: at most two words, then the verb."""
        nobody = "|".join(map(re.escape, [*self.negations, *self.no_speakers])) or "(?!)"
        verbs = "|".join(map(re.escape, self.reports)) or "(?!)"
        return rf"\s*(?:(?!(?:{nobody})\b){WORD.pattern}\s+){{0,2}}(?:{verbs})\b"

    @cached_property
    def after_quotation(self) -> re.Pattern:
        return re.compile(r"[\s,–—-]*" + self._speaker)

    @cached_property
    def after_comma(self) -> re.Pattern:
        return re.compile("," + self._speaker)


LEXICON = Lexicon()
BEGINNINGS = (6, 5, 4)
SCOPE = 4  # words that a negation reaches

#: Features of a clause, and what they weigh before anything is learned. Insults are multiplied by the weight of
#: their word; a threat starts with what an insult of weight ``USUAL`` weighs.
CLASSES = {
    "insult": 1.0, "insult:target": 1.2, "insult:not": 0.35, "insult:said": 0.45,
    "insult:not:said": 0.2, "threat:target": 4.0, "threat:target:not": 0.8,
    "threat:target:said": 1.2,
}
USUAL = 4.0
#: Each kind weighs at most this share of another, in this order.
AT_MOST = [
    ("insult:not", 0.9, "insult"), ("insult:said", 0.9, "insult"), ("insult", 1.0, "insult:target"),
    ("insult:not:said", 1.0, "insult:not"), ("insult:not:said", 1.0, "insult:said"),
    ("threat:target:not", 0.9, "threat:target"), ("threat:target:said", 0.9, "threat:target"),
]
#: The least and the greatest log-odds of a threat against a target; no label needs to hold one.
THREAT = 0.4, 3.0
#: The greatest log-odds of a match without weight.
OFFSET = -1.0


@dataclass
class Transducer:
    """A machine over symbols: ``step(state, symbol)`` gives the next state and the symbol written."""

    start: object
    step: object

    def then(self, after: "Transducer") -> "Transducer":
        """The composition: what this one writes, the other reads."""

        def step(state, symbol):
            mine, written = self.step(state[0], symbol)
            other, out = after.step(state[1], written)
            return (mine, other), out

        return Transducer((self.start, after.start), step)

    def run(self, symbols: list[str]) -> list[str]:
        state, out = self.start, []
        for symbol in symbols:
            state, written = self.step(state, symbol)
            out.append(written)
        return out


def _marked(symbol: str) -> bool:
    return symbol.startswith(("insult", "threat"))


def _negation(state: int, symbol: str) -> tuple[int, str]:
    """State: words that are still in the scope of a negation."""
    if symbol == "quote":
        return state, symbol
    if symbol == "not":
        return SCOPE, symbol
    return max(0, state - 1), symbol + ":not" if state and _marked(symbol) else symbol


def _report(state: bool, symbol: str) -> tuple[bool, str]:
    """State: whether somebody is being quoted."""
    return state or symbol in ("said", "quote"), symbol + ":said" if state and _marked(symbol) else symbol


def _target_ahead(state: bool, symbol: str) -> tuple[bool, str]:
    """Reads from the right. State: whether a target follows; what has none is left for ``_target``."""
    kind, _, marks = symbol.partition(":")
    if state and kind == "threat":
        return state, ":".join(filter(None, ("threat:target", marks)))
    if state and symbol == "insult":
        return state, "insult:target"
    return state or symbol == "target", symbol


def _target(state: bool, symbol: str) -> tuple[bool, str]:
    """State: whether a target has been named; violence without one is no threat."""
    state = state or symbol == "target"
    kind, _, marks = symbol.partition(":")
    if marks.startswith("target"):
        return state, symbol
    if kind == "threat":
        return state, ":".join(filter(None, ("threat:target" if state else "other", marks)))
    if kind == "insult" and state and not marks:
        return state, "insult:target"
    return state, symbol


MARKS = Transducer(0, _negation).then(Transducer(False, _report))
AHEAD, BEFORE = Transducer(False, _target_ahead), Transducer(False, _target)
GRAMMAR = MARKS.then(BEFORE)


def both_ways(symbols: list[str]) -> list[str]:
    """The grammar, with targets that stand after a word as well as before it."""
    return BEFORE.run(AHEAD.run(MARKS.run(symbols)[::-1])[::-1])


@dataclass
class Model:
    """``words`` and ``beginnings``: weights of insults. ``share``: of toxic texts without a match."""

    words: dict[str, float] = field(default_factory=dict)
    beginnings: dict[str, float] = field(default_factory=dict)
    weights: dict[str, float] = field(default_factory=lambda: dict(CLASSES))
    offset: float = -4.0
    more: float = 0.5
    share: float = 0.1
    lexicon: Lexicon = LEXICON

    def insult(self, word: str) -> float:
        found = self.words.get(word, 0.0)
        for size in BEGINNINGS:
            if len(word) >= size:
                found = max(found, self.beginnings.get(word[:size], 0.0))
        return found

    def symbol(self, word: str) -> tuple[str, float]:
        weight = self.insult(word)
        if weight:
            return "insult", weight
        return self.lexicon.classes.get(word, "other"), 1.0


def clauses(text: str, lexicon: Lexicon = LEXICON) -> Iterator[list[str]]:
    """The words of each clause of lower-case text, with an empty word where reported speech begins.

    A report goes on after a colon and to the end of a quotation in double marks on one line. It also
    begins with such a quotation, or with a clause, that a report verb follows: '"...", he said' and
    '..., he said'. Speech in single marks, or without a comma before the speaker, is not told.
    """
    quotations = list(QUOTATION.finditer(text))
    at, following, quoted_to, said = 0, 0, 0, False
    for end in [*CLAUSE_END.finditer(text), None]:
        stop = end.start() if end else len(text)
        begin = at if said or at < quoted_to or lexicon.after_comma.search(text, at, stop) else None
        heard, since = False, at
        while following < len(quotations) and quotations[following].start() < stop:
            one = quotations[following]
            following += 1
            heard = heard or not lexicon.said.isdisjoint(WORD.findall(text, since, one.start()))
            since = one.start()
            if begin is not None or heard or lexicon.after_quotation.match(text, one.end()):
                begin = one.start() if begin is None else begin
                quoted_to = one.end()
        if begin is None:
            words = WORD.findall(text, at, stop)
        else:
            words = [*WORD.findall(text, at, begin), "", *WORD.findall(text, begin, stop)]
        yield words
        if end:
            at = end.end()
            said = ":" in end.group() and (begin is not None or not lexicon.said.isdisjoint(words))


def clause_features(clause: str, model: Model) -> Counter:
    """Weight of each kind of match in a clause of lower-case text that is read only forwards and on
    its own; ``matches`` reads the clauses of a text both ways."""
    return _features(WORD.findall(clause), model, GRAMMAR.run)


def _features(words: list[str], model: Model, read) -> Counter:
    symbols, weights = [], []
    for word in words:
        symbol, weight = model.symbol(word)
        symbols.append(symbol)
        weights.append(weight)
    out: Counter = Counter()
    if not any(s in ("insult", "threat") for s in symbols):
        return out
    for written, weight in zip(read(symbols), weights):
        if written in CLASSES:
            out[written] += weight
        elif _marked(written):  # marks that have no class of their own weigh as the mildest
            out["insult:not:said"] += weight if written.startswith("insult") else 0.0
    return out


def matches(text: str, model: Model, finder) -> list[Counter]:
    """Features of the matched clauses of a text."""
    text = text.lower()
    if next(finder.iter(text), None) is None:
        return []
    found = (_features(c, model, both_ways) for c in clauses(text, model.lexicon))
    return [f for f in found if f]


def finder(model: Model):
    """Finds whether a text can match at all, in one pass."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for text in {*model.words, *model.beginnings, *model.lexicon.threats}:
        machine.add_word(text, 1)
    machine.make_automaton()
    return machine


def summary(clauses: list[Counter], model: Model) -> tuple[list[float], float]:
    """Features of the heaviest clause, and the logarithm of the number of other matched clauses."""
    if not clauses:
        return [0.0] * len(CLASSES), 0.0
    best = max(clauses, key=lambda f: sum(model.weights[c] * v for c, v in f.items()))
    return [best[c] for c in CLASSES], math.log(len(clauses))


def score(text: str, model: Model, machine) -> float:
    """Probability that a whole text is toxic; an empty text matches nothing."""
    clauses = matches(text, model, machine)
    if not clauses:
        return model.share
    values, more = summary(clauses, model)
    z = model.offset + model.more * more
    z += sum(model.weights[c] * v for c, v in zip(CLASSES, values))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _candidates(text: str) -> set[str]:
    """Words, and beginnings written with a star."""
    words = {w for w in WORD.findall(text.lower()) if not w.isdigit()}
    return words | {w[:n] + "*" for w in words for n in BEGINNINGS if len(w) >= n}


def _least_hashes(features: set[str]) -> tuple[int, ...]:
    """Texts that share many words share most of these, signed longs."""
    import xxhash

    words = [f for f in features if not f.endswith("*")]
    return tuple(
        min((xxhash.xxh64_intdigest(w, seed) for w in words), default=0) - 2**63 for seed in range(8)
    )


def _apart(hashes: list[tuple[int, ...]]) -> list[int]:
    """Which texts to count: of copies, told by equal least hashes, only the first."""
    seen: dict[tuple[int, int], int] = {}
    out = []
    for at, least in enumerate(hashes):
        alike = Counter(seen[k] for k in enumerate(least) if k in seen)
        if not alike or max(alike.values()) < 4:
            out.append(at)
            for k in enumerate(least):
                seen.setdefault(k, at)
    return out


def _least(n_toxic: int) -> int:
    """In how many toxic texts a word must occur."""
    return max(3, math.ceil(0.01 * n_toxic))


def _chosen(clean: dict[str, int], texts: list[list[str]], n_clean: int) -> dict[str, float]:
    """Weights of the fewest words and beginnings that explain the toxic texts, copies aside.

    ``clean``: in how many clean texts a word occurs. ``texts``: such words of each toxic text.

    Each must occur in some share of the texts, be rare in clean ones and explain two texts that nothing
    chosen before explains. Words that toxic texts share for other reasons explain none. At the end come
    words that always stood beside chosen ones, if they are as common and as rare in clean texts.
    """
    owners: dict[str, list[int]] = {}
    for at, features in enumerate(texts):
        for f in features:
            owners.setdefault(f, []).append(at)

    def weight(f: str) -> float:
        toxic_share = (len(owners[f]) + 0.5) / (len(texts) + 1)
        return math.log(toxic_share) - math.log((clean[f] + 0.5) / (n_clean + 1))

    least = _least(len(texts))
    weights = {f: weight(f) for f, o in owners.items() if len(o) >= least}
    weights = {f: w for f, w in weights.items() if w >= 3}
    gains = {f: len(owners[f]) for f in weights}
    explained = np.zeros(len(texts), dtype=bool)
    out = {}
    while gains:
        # Most weight of texts first; of equal ones the longer, more particular one.
        f = max(gains, key=lambda x: (gains[x] * weights[x], len(x), x))
        gain = int((~explained[owners[f]]).sum())
        if gain < 2:
            del gains[f]
        elif gain < gains[f]:
            gains[f] = gain
        else:
            del gains[f]
            explained[owners[f]] = True
            out[f] = weights[f]
    if out:
        common = np.median([len(owners[f]) for f in out]) / 2
        usual = np.median(list(out.values())) - 1
        stems = tuple(f.rstrip("*") for f in out)
        for f, w in weights.items():
            if not f.endswith("*") and len(owners[f]) >= common and w >= usual:
                if not f.startswith(stems):
                    out[f] = w
    return out


def fit(
    documents: DataFrame, labels: DataFrame, keep: Column, toxic: int = 2000, clean: int = 8000,
    lexicon: Lexicon = LEXICON,
) -> Model:
    """Learn from at most ``toxic`` and ``clean`` labelled ids, one whole text of each. Without toxic
    texts no insult is known and only threats match. ``lexicon`` gives the classes that are not learned."""
    ids = labelled_ids(labels, "toxic", keep, zeros=clean, ones=toxic).persist()
    sample = one_text_each(labelled_texts(documents, ids)).persist()

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(f, y) for y, t in zip(batch["_label"], batch["_text"]) for f in _candidates(t)]
            yield pd.DataFrame(rows, columns=["_feature", "_label"])

    kind = dict(ids.dtypes)["_id"]

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            least = [_least_hashes(_candidates(t)) for t in batch["_text"]]
            yield pd.DataFrame({"_id": batch["_id"], "_least": least})

    n_clean = sample.where("_label = 0").count()
    bad = sample.where("_label = 1").select("_id", "_text")
    held = bad.mapInPandas(hashes, f"_id {kind}, _least array<bigint>").orderBy("_id").collect()
    apart = [(held[at]["_id"],) for at in _apart([tuple(r["_least"]) for r in held])]
    n_toxic = len(apart)
    model = Model(lexicon=lexicon)
    if n_toxic:
        toxic_ids = F.broadcast(documents.sparkSession.createDataFrame(apart, f"_id {kind}"))
        toxic_texts = sample.where("_label = 1").join(toxic_ids, "_id", "left_semi")
        of_toxic, of_clean = F.sum("_label"), F.sum(1 - F.col("_label"))
        rate = F.col("_bad") / n_toxic
        weight = F.log((F.col("_bad") + 0.5) / (n_toxic + 1)) - F.log(
            (F.col("_good") + 0.5) / (n_clean + 1)
        )
        # What _chosen takes at most. Each is in a hundredth of the texts, so they are at most a hundred
        # times as many as a text has on average.
        common = F.col("_bad") >= _least(n_toxic)
        rare = (rate / (rate + F.col("_good") / max(1, n_clean)) >= 0.95) & (weight >= 3 - 1e-9)
        table = {
            r["_feature"]: r["_good"]
            for r in sample.where("_label = 0").unionByName(toxic_texts)
            .mapInPandas(features, "_feature string, _label int")
            .groupBy("_feature")
            .agg(of_toxic.alias("_bad"), of_clean.alias("_good"))
            .where(common & rare).select("_feature", "_good").collect()
        }
        names = {f: f for f in table}
        held = [
            [names[f] for f in _candidates(r["_text"]) if f in names]
            for r in toxic_texts.select("_text").toLocalIterator()
        ]
        for f, weight in _chosen(table, held, n_clean).items():
            if f.endswith("*"):
                model.beginnings[f[:-1]] = weight
            else:
                model.words[f] = weight

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = finder(model)
        for batch in batches:
            found = [summary(matches(t, model, machine), model) for t in batch["_text"]]
            yield pd.DataFrame({
                "_label": batch["_label"], "_more": [m for _, m in found],
                "_values": [v for v, _ in found],
            })

    rows = sample.mapInPandas(
        summarise, "_label int, _more double, _values array<double>"
    ).collect()  # at most toxic + clean rows
    sample.unpersist()
    ids.unpersist()
    _calibrate(model, rows)
    return model


def _newton(x: np.ndarray, y: np.ndarray, first: np.ndarray, strength: np.ndarray) -> np.ndarray:
    """Logistic coefficients, drawn to ``first``."""

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float(np.sum(np.logaddexp(0, z) - y * z) + np.sum(strength * (b - first) ** 2) / 2)

    beta, now = first.copy(), loss(first)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (p - y) + strength * (beta - first)
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(strength)
        step = np.linalg.solve(curve, slope)
        while loss(beta - step) > now and np.abs(step).max() > 1e-6:
            step /= 2
        beta = beta - step
        now = loss(beta)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def _below(x: np.ndarray, y: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Coefficients whose offset is at most ``OFFSET``: where every match of the sample is toxic, it is the
    weights that say so, and a match without weight stays harmless."""
    strength = np.array([0.05, *[1.0] * (len(first) - 1)])
    beta = _newton(x, y, first, strength)
    if beta[0] > OFFSET:
        fixed = np.array([1e9, *strength[1:]])
        beta = _newton(x, y, np.array([OFFSET, *first[1:]]), fixed)
    return beta


def _calibrate(model: Model, rows) -> None:
    """Fit offset and weights to the labels.

    First one scale for all kinds of matches, then each kind around its share of it. A kind without an
    example keeps its share of a plain insult, so it moves with the offset as that does. Last come the bounds of
    ``AT_MOST`` and ``THREAT``.
    """
    insults = [*model.words.values(), *model.beginnings.values()]
    usual = float(np.median(insults)) / USUAL if insults else 1.0
    shares = {c: w * (usual if c.startswith("threat") else 1.0) for c, w in CLASSES.items()}
    model.weights = dict(shares)
    if not rows:
        return
    x = np.array([[1.0, r["_more"], *r["_values"]] for r in rows])
    y = np.array([r["_label"] for r in rows], dtype=float)
    hit = x[:, 2:].any(axis=1)
    unmatched = y[~hit]
    model.share = min(0.49, float((unmatched.sum() + 0.5) / (len(unmatched) + 2)))
    x, y = x[hit], y[hit]
    if len(y):
        first = np.array(list(shares.values()))
        together = np.column_stack([x[:, :2], x[:, 2:] @ first])
        offset, more, scale = _below(together, y, np.array([model.offset, model.more, 1.0]))
        scale = max(scale, 0.1)
        beta = _below(x, y, np.array([offset, more, *(scale * first)]))
        model.offset, model.more = float(beta[0]), float(beta[1])
        seen = x[:, 2:].any(axis=0)
        plain = float(beta[2]) if seen[0] else scale
        model.weights = {
            c: max(0.0, float(b) if there else plain * share)
            for (c, share), b, there in zip(shares.items(), beta[2:], seen)
        }
    weights = model.weights
    weights["insult:target"] = max(weights["insult:target"], weights["insult"])
    least, most = (z - model.offset for z in THREAT)
    weights["threat:target"] = min(max(weights["threat:target"], least), most)
    for kind in ("threat:target:not", "threat:target:said"):
        weights[kind] = min(weights[kind], weights["threat:target"] * CLASSES[kind] / CLASSES["threat:target"])
    for kind, share, other in AT_MOST:
        weights[kind] = min(weights[kind], share * weights[other])


def toxicity_score(text: Column, model: Model) -> Column:
    """The probability that a text (null: empty) is toxic."""

    @pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        machine = finder(model)
        return pd.Series([score(t, model, machine) for t in texts], dtype="float64")

    return of(whole(text))
