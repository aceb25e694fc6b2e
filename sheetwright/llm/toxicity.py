"""Toxicity by a weighted finite-state grammar over clauses.

A clause is read word by word.  The lexical transducer turns words into
symbols: insults and stems of insults with learned weights, and the fixed
closed classes of targets, negations, modals, harms and speech verbs.  Its
output passes through four more transducers, composed one after another:

* threat: a modal, then a harm verb within a few words, becomes a threat;
* target: an insult or threat near an address (you, your, ...) becomes targeted;
* negation: one within reach of a negation becomes negated;
* reported speech: one after a speech verb in its clause becomes reported.

A matched clause so ends in weighted symbols, and a document's features are
the weights per kind of symbol, summed over its matched clauses, and the
number of matches after the first.  A logistic function of their logarithms is
the score.  Isolated function words score nothing.

The insult lexicon and the logistic weights are learned from a bounded sample
of labelled rows: at most ``sample`` rows of each label, the first in a seeded
order, equal texts once.  A word, or a stem of 4 to 6 letters, is an insult
if it occurs in ``support`` or more toxic texts of the sample and nearly never
in clean ones; at most ``lexicon`` entries, chosen among the 4 * ``lexicon``
such terms that most toxic texts of the sample have.  The counting is a Spark job.

Scale: the model (lexicon and seven weights) goes to the tasks; whole texts are
scored where they are scanned, without a shuffle.  Candidate words are found
on the bytes of a batch; only clauses with one are read by the grammar.

Defined results: a null or blank text has no clause and gets the score of no
match; without any labelled toxic row nothing matches; an empty table gives no
rows; repeated rows get a score each; texts of any length are read whole;
columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetwright.llm.common import lowest, staged
from sheetwright.llm.textbytes import prefix_hash, random_words, slices, spans_hash, text_bytes, words

# Closed classes of the grammar (English, German, French, Spanish).
TARGET = "you your yours yourself u ur du dich dir dein deine euch ihr tu te toi ton ta vous votre tú tu usted ustedes vosotros".split()
NEGATION = "not no never nobody isn't aren't don't doesn't didn't nicht kein keine nie niemals ne pas jamais aucun nunca jamás ningún".split()
MODAL = "will shall gonna going should must werde wirst wird sollst vais vas va doit voy vas va debe".split()
HARM = "kill hurt beat destroy shoot stab burn hang murder töten schlagen umbringen tuer frapper matar golpear".split()
SPEECH = "said says saying told claims claimed wrote writes called quoted sagte sagt schrieb dit disait écrit dijo dice escribió".split()

STEMS = (4, 5, 6)
REACH = 4
CLAUSE_END = b".!?;\n"
KINDS = ("plain", "targeted", "negated", "reported", "threat")
FEATURES = (*KINDS, "more")
PIECE = 1 << 20

_LETTERS = random_words(256, 41)
_LETTERS[[b for b in range(128) if not chr(b).isalpha()]] = 0
# A word is a run of letters, when learning and when scoring; what is no letter beyond ASCII becomes a space, a typographic apostrophe a plain one.
OTHER_SIGNS = r"[^\x00-\x7F\p{L}]"


class Transducer:
    """A weighted finite-state transducer over symbols.

    ``arcs`` maps (state, symbol kind) to (next state, output kind, weight);
    where no arc is given, ``other`` says how a state goes on while the symbol
    passes unchanged.
    """

    def __init__(self, arcs: dict, other: dict):
        self.arcs, self.other = arcs, other

    def __call__(self, symbols: list[tuple[str, float]]) -> list[tuple[str, float]]:
        state, out = 0, []
        for kind, weight in symbols:
            if (arc := self.arcs.get((state, kind))) is not None:
                state, kind, factor = arc
                out.append((kind, weight * factor if kind in KINDS else weight))
            else:
                out.append((kind, weight))
                state = self.other.get(state, state)
        return out


def within_reach(opener: str, changes: dict[str, str], factor: float, reach: int = REACH) -> Transducer:
    """After ``opener``, for ``reach`` symbols, the kinds in ``changes`` become others."""
    arcs = {(s, opener): (reach, opener, 1.0) for s in range(reach + 1)}
    arcs |= {(s, kind): (s - 1, new, factor) for s in range(1, reach + 1) for kind, new in changes.items()}
    return Transducer(arcs, {s: s - 1 for s in range(1, reach + 1)})


THREATS = within_reach("modal", {"harm": "threat"}, 1.0)
TARGETS = within_reach("target", {"plain": "targeted"}, 1.0)
NEGATIONS = within_reach("negation", {"plain": "negated", "targeted": "negated", "threat": "negated"}, 1.0)
REPORTS = Transducer(
    {(0, "speech"): (1, "speech", 1.0), **{(1, k): (1, "reported", 1.0) for k in ("plain", "targeted", "threat", "negated")}}, {})


def composed(symbols: list[tuple[str, float]]) -> list[tuple[str, float]]:
    """The grammar: threat, target (from the left, then from the right), negation and reported speech over one clause."""
    symbols = TARGETS(THREATS(symbols))
    symbols = TARGETS(symbols[::-1])[::-1]
    return REPORTS(NEGATIONS(symbols))


class Lexicon:
    """Words and stems (marked by a final ``*``) with weights, and the closed classes."""

    def __init__(self, weights: dict[str, float]):
        self.words = {w: v for w, v in weights.items() if not w.endswith("*")}
        self.stems = {w[:-1]: v for w, v in weights.items() if w.endswith("*")}
        self.classes = {w: k for k, ws in (("target", TARGET), ("negation", NEGATION), ("modal", MODAL), ("harm", HARM), ("speech", SPEECH)) for w in ws}
        sizes: dict[int, list] = {}
        for s in self.stems:
            sizes.setdefault(len(s.encode()), []).append(s.encode())
        self.whole = hashes_of([w.encode() for w in [*self.words, *HARM]])
        self.starts = {n: hashes_of(s) for n, s in sizes.items()}

    def symbol(self, word: str) -> tuple[str, float]:
        if (weight := self.words.get(word)) is not None:
            return "plain", weight
        for n in STEMS:
            if (weight := self.stems.get(word[:n])) is not None and len(word) >= n:
                return "plain", weight
        return self.classes.get(word, "other"), 1.0

    def candidates(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, byte position) of the words that may be insults or harms."""
        start, end, row, hashes = words(data, offsets, _LETTERS)
        if not len(start):
            return row, start
        hit = among(hashes, self.whole)
        if self.starts:
            prefix = prefix_hash(_LETTERS[data])
            for n, known in self.starts.items():
                long = np.flatnonzero(end - start >= n)
                hit[long] |= among(spans_hash(prefix, start[long], start[long] + n), known)
        return row[hit], start[hit]


def hashes_of(items: list[bytes]) -> np.ndarray:
    if not items:
        return np.empty(0, np.uint64)
    data = np.frombuffer(b"".join(items), np.uint8)
    ends = np.cumsum([len(x) for x in items])
    return np.sort(spans_hash(prefix_hash(_LETTERS[data]), ends - [len(x) for x in items], ends))


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


class _Cut(dict):
    """Translation that keeps letters and apostrophes and turns every other character into a space."""

    def __missing__(self, c: int) -> int:
        self[c] = kept = c if chr(c).isalpha() or c == 0x27 else 0x27 if c == 0x2019 else 0x20
        return kept


WORD_CUT = _Cut()


def clause_symbols(lexicon: Lexicon, clause: str) -> list[tuple[str, float]]:
    """The symbols of a clause's words.

    A form with apostrophes (isn't) that is a word of a closed class is one
    symbol; of any other (l'idiot, 'idiot') the parts that have a symbol count,
    or one other word where none has.
    """
    symbols = []
    for form in clause.translate(WORD_CUT).split():
        parts = [w for w in form.split("'") if w]
        if len(parts) > 1 and (kind := lexicon.classes.get(form.strip("'"))) is not None:
            symbols.append((kind, 1.0))
        elif parts:
            found = [lexicon.symbol(w) for w in parts]
            symbols += [f for f in found if f[0] != "other"] or [("other", 1.0)]
    return symbols


def clause_features(lexicon: Lexicon, clause: str) -> dict[str, float]:
    """Weights of the symbols in which a clause ends, and their number."""
    found: dict[str, float] = {}
    for kind, weight in composed(clause_symbols(lexicon, clause)):
        if kind in KINDS:
            found[kind] = found.get(kind, 0.0) + weight
            found["more"] = found.get("more", 0.0) + 1.0
    return found


def text_features(lexicon: Lexicon, column: pa.Array) -> np.ndarray:
    """Features of each text (rows, FEATURES)."""
    lower = pc.replace_substring(pc.utf8_lower(column.cast(pa.string())), "\u2019", "'")
    data, offsets = text_bytes(pc.replace_substring_regex(lower, OTHER_SIGNS, " "))
    out = np.zeros((len(offsets) - 1, len(FEATURES)))
    ends_clause = np.zeros(256, bool)
    ends_clause[list(CLAUSE_END)] = True
    for a, b in slices(offsets, PIECE):
        part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        row, at = lexicon.candidates(part, own)
        if not len(row):
            continue
        stops = np.flatnonzero(ends_clause[part])
        after = np.searchsorted(stops, at)
        left = np.maximum(own[row], np.where(after > 0, stops[np.maximum(after - 1, 0)] + 1, 0) if len(stops) else 0)
        right = np.minimum(own[row + 1], np.where(after < len(stops), stops[np.minimum(after, len(stops) - 1)], own[-1]) if len(stops) else own[-1])
        for r, x, y in sorted(set(zip(row.tolist(), left.tolist(), right.tolist()))):
            for kind, weight in clause_features(lexicon, part[x:y].tobytes().decode()).items():
                out[a + r, FEATURES.index(kind)] += weight
    out[:, -1] = np.maximum(out[:, -1] - 1, 0)
    return out


def fold(doc_id: str):
    """Fold 0 to 4 of a document: CRC-32 of its id as text, modulo 5; null for a null id."""
    return F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 5


def training_sample(docs: DataFrame, labels: DataFrame, sample: int, seed: int) -> tuple[DataFrame, dict[int, float]]:
    """Rows (text, toxic): at most ``sample`` labelled rows of each label outside the held-out fold, equal texts once.

    Also how many labelled rows one sampled row of each label stands for.
    """
    usable = labels.select("doc_id", "toxic").where("toxic in (0, 1) and doc_id is not null").where(fold("doc_id") != 0)
    n = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    picked = [usable.where((F.col("toxic") == label) & lowest(order, F.lit(n.get(label, 0)), sample)).orderBy(order, "doc_id").limit(sample)
              for label in (0, 1)]
    chosen = picked[0].unionByName(picked[1])
    chosen = F.broadcast(chosen.groupBy("doc_id").agg(F.max("toxic").alias("toxic")))  # bounded: twice the sample
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").where("text is not null").groupBy("text").agg(F.max("toxic").alias("toxic"))
    return rows, {label: max(1.0, n.get(label, 0) / sample) for label in (0, 1)}


def learned_lexicon(sample: DataFrame, each: dict[int, float], support: int, purity: float = 0.9, lexicon: int = 5000) -> dict[str, float]:
    """Words and stems that mark toxic texts, with the log-odds of their presence."""
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    stems = F.flatten(F.transform(F.array(*map(F.lit, STEMS)), lambda n: F.transform(
        F.filter("words", lambda w: F.char_length(w) >= n), lambda w: F.concat(F.substring(w, F.lit(1), n), F.lit("*")))))
    terms = sample.select("toxic", found.alias("words")).select(
        "toxic", F.explode(F.array_distinct(F.concat("words", stems))).alias("term"))
    counts = terms.groupBy("term").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    bad, good = F.col("bad") * each[1], F.col("good") * each[0]
    rows = counts.where((F.col("bad") >= support) & (bad >= purity * (bad + good)))
    rows = rows.orderBy(F.desc("bad"), "good", "term").limit(4 * lexicon).collect()  # bounded by the lexicon
    # Of a term and those that begin with it, the one with most toxic and fewest clean texts stays, a stem rather than a word.
    rows = sorted(rows, key=lambda r: (10 * r["good"] * each[0] - r["bad"] * each[1], -r["term"].endswith("*"), len(r["term"]), r["term"]))
    chosen: dict[str, float] = {}
    for r in rows:
        term, bare = r["term"], r["term"].rstrip("*")
        covered = any(bare[:k] + "*" in chosen for k in STEMS)
        covers = term.endswith("*") and any(c.startswith(bare) for c in chosen)
        if not covered and not covers and len(chosen) < lexicon:
            chosen[term] = math.log((r["bad"] + 0.5) / (n[1] + 1)) - math.log((r["good"] + 0.5) / (n.get(0, 0) + 1))
    return chosen


# Prior of the weights: all kinds of match speak for toxicity, negated and reported ones less.
PRIOR = np.array([1.0, 1.2, 0.6, 0.6, 1.0, 0.5, -3.0])


def logistic(features: np.ndarray, label: np.ndarray, weight: np.ndarray, ridge: float = 0.01, steps: int = 60) -> np.ndarray:
    """Weights (features, then bias) of a logistic regression drawn towards ``PRIOR``, by Newton's method."""
    x = np.column_stack((features, np.ones(len(features))))
    weight = weight / weight.mean()
    penalty = np.r_[np.full(features.shape[1], ridge), 1e-6] * len(x)
    theta = PRIOR.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (weight * (p - label)) + penalty * (theta - PRIOR)
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        theta = theta - step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return theta


class Model:
    def __init__(self, weights: dict[str, float], theta: np.ndarray):
        self.weights, self.theta = weights, theta

    def score(self, features: np.ndarray) -> np.ndarray:
        x = np.column_stack((np.log1p(np.maximum(features, 0)), np.ones(len(features))))
        return 1 / (1 + np.exp(-np.clip(x @ self.theta, -30, 30)))


def feature_rows(df: DataFrame, weights: dict[str, float], keep: str) -> DataFrame:
    """Column ``keep`` and the features of ``text`` as an array."""
    schema = df.select(keep, F.array(F.lit(0.0)).alias("features")).schema

    def run(batches):
        lexicon = Lexicon(weights)
        for batch in batches:
            found = text_features(lexicon, batch.column("text"))
            values = pa.FixedSizeListArray.from_arrays(pa.array(found.reshape(-1)), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(keep), values], names=[keep, "features"])

    return df.select(keep, "text").mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 8000, seed: int = 13, support: int = 6) -> Model:
    """Lexicon and weights from a bounded sample (``sample`` rows of each label)."""
    rows, each = training_sample(docs, labels, sample, seed)
    rows = staged(rows, "toxicity-sample")
    if not rows.where("toxic = 1").count():
        return Model({}, PRIOR)
    weights = learned_lexicon(rows, each, support)
    found = sorted((r["toxic"], *r["features"]) for r in feature_rows(rows, weights, "toxic").collect())  # bounded: twice the sample
    table = np.array(found)
    weight = np.where(table[:, 0] == 1, each[1], each[0])
    return Model(weights, logistic(np.log1p(table[:, 1:]), table[:, 0], weight))


def scored(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted): one per row of ``docs``."""
    model = fit(docs, labels, **options)

    def run(batches):
        lexicon = Lexicon(model.weights)
        for batch in batches:
            score = model.score(text_features(lexicon, batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, score double, predicted int")
    return found.select("doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score", "predicted")
