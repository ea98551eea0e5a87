"""Language identification by cross-parsing entropy.

Per language, a suffix automaton is built from labelled running text. A text is cross-parsed
with it: the longest match from the current place is one phrase, then the next begins. The
phrases a language needs, times the logarithm of its training length and divided by the
length parsed, estimate the cross entropy; the language with the least wins. Texts are read
as lower-case letters with one space for each run of anything else, in front and behind, so
phrases reach over words. All places of a batch are parsed in step: a text is split after
every ``SPAN`` letters and spaces, which ends the open phrase there (for all languages alike).

Training uses a bounded sample: at most ``rows`` labelled rows per language (fewer when
there are over 50 languages), the distinct texts with the smallest hashes. Their whole
texts are cut into pieces of ``piece`` characters, and the distinct pieces with the smallest
hashes, wherever they stand, teach up to ``chars`` characters per language.

Nulls, ties, edges: a null text, or one without a letter, is ``und`` with score 0, and so is
any text if nothing was learned; ties go to the language first by code point; rows with a
null lang or text teach nothing; repeated rows are predicted one by one; an empty table
gives no row. Columns named like the result's are replaced, all others pass through.
"""
from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
SPAN = 1024                                            # letters and spaces parsed as one run
BLOCK = 1 << 19                                        # characters a worker holds decoded
_BMP = 1 << 16


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def spaced(text: str) -> str:
    """Lower-case letters of ``text``, one space for each run of anything else and at both ends."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    return f" {' '.join(words)} " if words else ""


def automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the suffix automaton of ``text``, by state; state 0 is the root."""
    go: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for ch in text:
        cur = len(go)
        go.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and ch not in go[p]:
            go[p][ch] = cur
            p = link[p]
        if p >= 0:
            q = go[p][ch]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                copy = len(go)
                go.append(dict(go[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and go[p].get(ch) == q:
                    go[p][ch] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    return go


class Model:
    """Automata of all languages in one table of displaced rows: the transition of state s by
    letter c stands at ``base[s] + c`` if ``owner`` names s there. State 0 has no transition."""

    def __init__(self, training: dict[str, str]):
        self.langs = sorted(training)
        letters = sorted({c for t in training.values() for c in t if c != "\n"} | {" "})
        self.code = {c: i for i, c in enumerate(letters)}
        n = self.n_letters = len(letters) + 1          # the last one stands for any other letter
        self.weight = [math.log2(max(2, len(training[x]))) for x in self.langs]
        rows: list[dict[int, int]] = [{}]
        self.root = np.zeros((len(self.langs), n), np.intp)
        for k, lang in enumerate(self.langs):
            first = len(rows)
            for d in automaton(training[lang]):
                rows.append({self.code[c]: t + first for c, t in d.items() if c != "\n"})
            for c, t in rows[first].items():
                self.root[k, c] = t
        base, slots = np.zeros(len(rows), np.intp), {}
        free = [n]                                     # first slot tried, by number of transitions
        for s in sorted(range(1, len(rows)), key=lambda s: -len(rows[s])):
            row = rows[s]
            cs = list(row)
            if not cs:
                continue
            if len(cs) == 1:                           # any free slot does
                at = free[0]
                while at in slots:
                    at += 1
                free[0] = at + 1
                b = at - cs[0]
            else:
                while len(free) <= len(cs):
                    free.append(n)
                b = free[len(cs)]
                while any(b + c in slots for c in cs):
                    b += 1
                free[len(cs)] = b
            base[s] = b
            for c, t in row.items():
                slots[b + c] = (s, t)
        size = max(slots, default=0) + n + 1
        self.base, self.owner, self.next = base, np.full(size, -1, np.intp), np.zeros(size, np.intp)
        for at, (s, t) in slots.items():
            self.owner[at], self.next[at] = s, t

    def phrases(self, codes: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Phrases each language needs for each run ``codes[start:start + length]``: languages x runs."""
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        state = np.zeros((len(self.langs), len(start)), np.intp)
        count = np.zeros(state.shape, np.int32)
        live = len(start)
        for j in range(int(length[0]) if len(length) else 0):
            while length[live - 1] <= j:
                live -= 1
            c = codes[start[:live] + j]
            now = state[:, :live]
            slot = self.base[now]
            slot += c
            goes = self.owner[slot] == now
            count[:, :live] += ~goes
            state[:, :live] = np.where(goes, self.next[slot], self.root[:, c])
        out = np.empty_like(count)
        out[:, order] = count
        return out


class Parser:
    """Cross-parses texts with a model, in blocks of ``BLOCK`` characters."""

    def __init__(self, model: Model):
        self.model = model
        other = model.n_letters - 1
        space = model.code[" "]
        self.table = np.array([model.code.get(chr(i), other) if chr(i).isalpha() else space for i in range(_BMP)], np.intp)

    def codes(self, text: np.ndarray) -> np.ndarray:
        out = self.table[np.minimum(text, _BMP - 1)]
        for i in np.flatnonzero(text >= _BMP):
            ch = chr(text[i])
            out[i] = self.model.code.get(ch, self.model.n_letters - 1) if ch.isalpha() else self.model.code[" "]
        return out

    def block(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(phrases per part and language, letters and spaces per part; 0 without a letter)."""
        low = [f" {p.lower()} " for p in parts]
        ends = np.cumsum([len(p) for p in low])
        text = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.codes(text)
        gap = codes == self.model.code[" "]
        keep = np.ones(len(codes), bool)
        keep[1:] = ~(gap[1:] & gap[:-1])
        begin = np.concatenate([[0], ends[:-1]])
        keep[begin] = True
        size = np.add.reduceat(keep, begin, dtype=np.intp)
        codes = codes[keep]
        begin = np.cumsum(size) - size
        size = np.where(size > 2, size, 0)             # only spaces
        runs = -(-size // SPAN)
        own = np.repeat(np.arange(len(parts)), runs)
        off = (np.arange(len(own)) - np.repeat(np.cumsum(runs) - runs, runs)) * SPAN
        count = self.model.phrases(codes, begin[own] + off, np.minimum(SPAN, size[own] - off))
        out = np.zeros((len(parts), len(self.model.langs)), np.int64)
        np.add.at(out, own, count.T)
        return out, size

    def totals(self, texts: Iterable[str | None], n: int) -> tuple[np.ndarray, np.ndarray]:
        """``block`` for ``n`` texts of any length, nulls among them."""
        total, size = np.zeros((n, len(self.model.langs)), np.int64), np.zeros(n, np.int64)
        own: list[int] = []
        parts: list[str] = []
        held = 0

        def flush():
            nonlocal held
            if own:
                a, b = self.block(parts)
                np.add.at(total, own, a)
                np.add.at(size, own, b)
            own.clear()
            parts.clear()
            held = 0

        for i, t in enumerate(texts):
            for lo in range(0, len(t or ""), BLOCK):
                own.append(i)
                parts.append(t[lo:lo + BLOCK])
                held += len(parts[-1])
                if held >= BLOCK:
                    flush()
        flush()
        return total, size

    def predict(self, texts: Iterable[str | None], n: int) -> tuple[list[str], list[float]]:
        """(language, score) of each of ``n`` texts: the score is the runner-up's share of the cross
        entropies of the best two (with one language, of its own and a phrase per letter)."""
        if not n:
            return [], []
        if not self.model.langs:
            return [UNKNOWN] * n, [0.0] * n
        total, size = self.totals(texts, n)
        cost = total * np.array(self.model.weight)
        best = cost.argmin(axis=1)
        least = cost[np.arange(n), best]
        second = np.partition(cost, 1, axis=1)[:, 1] if cost.shape[1] > 1 else np.maximum(size, least)
        score = second / np.maximum(least + second, 1e-9)
        lang = [self.model.langs[b] if s else UNKNOWN for b, s in zip(best, size)]
        return lang, [float(x) if s else 0.0 for x, s in zip(score, size)]


def train(labelled: DataFrame, rows: int = 200, chars: int = 30_000, piece: int = 300) -> Model:
    """A model from ``text`` and ``lang`` of ``labelled`` (see above for the bounds)."""
    own = labelled.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
    own = own.withColumn("h", F.xxhash64("text"))
    # one number a language, like the automata that the model holds for each
    count = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    rows = max(10, min(rows, 50 * rows // max(1, len(count))))
    # hashes below a fraction of the range leave some 4 x rows texts of a language; all if it has few
    part = F.create_map(*[F.lit(x) for lang, n in count.items() for x in (lang, 4.0 * rows / max(1, n))])
    near = own.where((F.col("h") + F.lit(2.0**63)) / F.lit(2.0**64) < part[F.col("lang")]) if count else own.limit(0)
    near = near.dropDuplicates(["lang", "h", "text"])
    order = Window.partitionBy("lang").orderBy("h", "text")
    picked = near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= rows)
    pieces = picked.select("lang", F.explode(F.regexp_extract_all("text", F.lit(r"(?s).{1,%d}" % piece), F.lit(0))).alias("p"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("p"), "p")
    taken = (pieces.distinct().withColumn("r", F.row_number().over(order))
             .where(F.col("r") <= max(1, chars // piece)).select("lang", "p", "r"))
    training: dict[str, str] = {}
    for r in sorted(taken.collect(), key=lambda r: (r["lang"], r["r"])):
        text = spaced(r["p"])
        if text:                                       # a line feed, never parsed, ends a piece
            training[r["lang"]] = training.get(r["lang"], "") + text + "\n"
    return Model(training)


def predict(docs: DataFrame, model: Model, lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score. The model's size is bounded by the
    training bounds, so it is broadcast; only ``text`` is read for a prediction."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name not in (lang_col, score_col)]
    out = T.StructType([*kept, T.StructField(lang_col, T.StringType()), T.StructField(score_col, T.DoubleType())])

    def run(batches):
        parser = Parser(shared.value)
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                lang, score = parser.predict((t.as_py() for t in part.column("text")), part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f.name) for f in kept), pa.array(lang, pa.string()),
                     pa.array(score, pa.float64())], out.names)

    return docs.select(*[f.name for f in kept]).mapInArrow(run, out)


def with_letters(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose text has a letter."""
    def run(batches):
        for b in batches:
            yield b.filter(pa.array(map(has_letter, b.column("text").to_pylist()), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id) -> F.Column:
    """crc32 of the id as text leaves remainder 2 by 4 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2
