"""Problem 7: freely typed values mapped to a reference list, by BK-trees under a true edit metric.

Values are normalised, each distinct (kind, value) is looked up once, and reports the closest entry of its kind or
none. A BK-tree (Burkhard and Keller, 1973) prunes by the triangle inequality, so the distance has to be a metric:
unrestricted Damerau-Levenshtein, in which a swap of neighbours is one edit. The tree is broadcast if the reference
list is small (counted first); a larger list is split into shards with a tree each, and the shards' winners are merged.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import cut

#: Words that people write around a name.
BEFORE = frozenset("a an and at by for from in of on our ours the their this to using versus via vs with".split())
AFTER = frozenset("al approach baseline benchmark collection corpus data database dataset et eval evaluation method metric model network ours re rerun results run score set split system test train training val validation value values".split())
_SIZE = re.compile(r"[0-9]+(?:k(?![a-z])|m(?![a-z])|b(?![a-z])|d(?![a-z]))?")
_TOKEN = re.compile(r"[a-z]+\.?|[0-9]+(?:[a-z](?![a-z]))?")


def edit_distance(a: str, b: str, bound: int | None = None) -> int:
    """Unrestricted Damerau-Levenshtein distance: insert, delete, replace, and swap of neighbours, a true metric.

    A distance above ``bound`` may come out as any number above it: the least value of a row never falls from row to
    row, nor is the distance below the difference of the lengths.
    """
    if a == b:
        return 0
    if not a or not b:
        return len(a) + len(b)
    far = len(a) + len(b)
    if bound is None:
        bound = far
    elif abs(len(a) - len(b)) > bound:
        return bound + 1
    last: dict[str, int] = {}
    d = [[far] * (len(b) + 2), [far, *range(len(b) + 1)]]
    for i, x in enumerate(a, 1):
        before, row, match = d[i], [far, i], 0
        for j, y in enumerate(b, 1):
            k, m = last.get(y, 0), match
            if x == y:
                match = j
            best, above, left = before[j] + (x != y), before[j + 1], row[j]
            if above < best:
                best = above + 1
            if left < best:
                best = left + 1
            if k and m and (swap := d[k][m] + i - k + j - m - 1) < best:
                best = swap
            row.append(best)
        if min(row) > bound:
            return bound + 1
        last[x] = i
        d.append(row)
    return d[-1][-1]


class BKTree:
    """Entries under :func:`edit_distance`; ``within`` returns every entry at most ``most`` edits away."""

    def __init__(self, words: Iterator[str] | list[str]) -> None:
        self.root: tuple[str, dict] | None = None
        for word in words:
            self.add(word)

    def add(self, word: str) -> None:
        if self.root is None:
            self.root = (word, {})
            return
        node = self.root
        while (gap := edit_distance(word, node[0])) > 0:
            if gap not in node[1]:
                node[1][gap] = (word, {})
                return
            node = node[1][gap]

    def within(self, word: str, most: int) -> list[tuple[str, int]]:
        found, stack = [], [self.root] if self.root else []
        while stack:
            entry, children = stack.pop()
            gap = edit_distance(word, entry, most + max(children, default=0))  # beyond that no child can be near
            if gap <= most:
                found.append((entry, gap))
            stack.extend(child for at, child in children.items() if gap - most <= at <= gap + most)
        return found


def plain(value: str) -> str:
    """Lower case without accents, tags, citations and signs."""
    text = unicodedata.normalize("NFKD", value)
    text = "".join(ch for ch in text if not unicodedata.combining(ch)).lower()
    text = re.sub(r"<(su[pb])>.*?</\1>|</?[a-z]+>|\[[^\]]*\]", " ", text)
    text = text.replace("@", " @ ")
    return " ".join(text.replace("_", " ").split())


def tokens(text: str) -> list[str]:
    """Words and numbers in order; a word that was cut short keeps its point."""
    return _TOKEN.findall(text)


def sizes(text: str) -> tuple[str, ...]:
    """Numbers and size marks, which belong to a name, in order."""
    return tuple(sorted(_SIZE.findall(text)))


def allowed(key: str) -> int:
    """Edits allowed for a key by its number of letters."""
    letters = sum(ch.isalpha() for ch in key)
    return 0 if letters <= 4 else 1 if letters <= 5 else 2


def readings(value: str | None) -> list[list[str]]:
    """The token lists that a value may name: whole, without brackets, inside brackets, without words around."""
    if value is None:
        return []
    text = plain(value)
    inside = re.findall(r"\(([^()]*)\)", text)
    lists = [tokens(re.sub(r"\([^()]*\)", " ", text)), *(tokens(x) for x in inside), tokens(text)]
    out: list[list[str]] = []
    for words in lists:
        if not words:
            continue
        start = 0
        while start < len(words) - 1 and words[start].rstrip(".") in BEFORE:
            start += 1
        core = words[start:]
        while core:
            if core not in out:
                out.append(core)
            if len(core) > 1 and core[-1].rstrip(".") in AFTER:
                core = core[:-1]
            else:
                break
    return out


class Matcher:
    """Reference entries (entity_id, name, full_name) of one kind."""

    def __init__(self, entries: list[tuple[int, str, str | None]]) -> None:
        self.forms: dict[str, set[int]] = {}
        self.words: dict[int, list[list[str]]] = {}
        self.sizes: dict[int, tuple[str, ...]] = {}
        self.single: dict[int, str] = {}
        self.long: set[tuple[str, int]] = set()  # keys of long forms, which may lack the short form's number
        for entity, name, full in entries:
            short = tokens(plain(name))
            self.sizes[entity] = sizes("".join(short))
            self.single[entity] = short[-1] if len(short) > 1 and len(short[-1]) == 1 and short[-1].isalpha() else ""
            lists = [short] if full is None else [short, tokens(plain(full)), tokens(plain(full)) + [x for x in short if x[0].isdigit()]]
            self.words[entity] = lists
            for words in lists:
                for key in {"".join(words), "".join(sorted(words))}:
                    self.forms.setdefault(key, set()).add(entity)
                    if words is not short:
                        self.long.add((key, entity))
        self.tree = BKTree(sorted(self.forms))
        self.near: dict[str, list[tuple[str, int]]] = {}
        self.holders: dict[str, set[int]] = {}
        for entity, lists in self.words.items():
            for word in spelled_words(lists):
                self.holders.setdefault(word, set()).add(entity)

    def _agrees(self, entity: int, words: list[str], key: str) -> bool:
        mine = sizes("".join(words))
        if mine != self.sizes[entity] and not ((key, entity) in self.long and not mine):
            return False
        last = words[-1] if len(words) > 1 and len(words[-1]) == 1 and words[-1].isalpha() else ""
        return not (last and self.single[entity] and last != self.single[entity])

    def candidates(self, value: str | None) -> list[tuple[int, int, tuple[str, ...]]]:
        """(entity_id, edits, doubts) of every entry within reach; edits are -1 where a form is spelled exactly.

        ``doubts`` are the words that the entry has not: if one is a word of other entries, it is no misspelling.
        Each entry is judged by itself, so that the candidates of a list are those of its parts.
        """
        read = readings(value)
        out: dict[tuple[int, int, tuple[str, ...]], None] = {}
        for words in read:  # spelled exactly: nothing can be closer
            for key in {"".join(bare := [x.rstrip(".") for x in words]), "".join(sorted(bare))}:
                out |= {(entity, -1, ()): None for entity in self.forms.get(key, ()) if self._agrees(entity, words, key)}
        for words in () if out else read:
            for key, entity, gap in self._near(words):
                if self._agrees(entity, words, key):
                    own = {w for known in self.words[entity] for w in known}
                    out[entity, gap, tuple(sorted({w for w in words if len(w) > 2 and w not in own})) if gap else ()] = None
        return list(out)

    def match(self, value: str | None) -> tuple[int, int] | None:
        """(entity_id, edits) of the one closest entry, None if there is none or several are as close."""
        best: dict[int, int] = {}
        for entity, edits, doubts in self.candidates(value):
            if edits < best.get(entity, 99) and not any(w in self.holders for w in doubts):
                best[entity] = edits
        if not best:
            return None
        least = min(best.values())
        winners = [k for k, v in best.items() if v == least]
        return (winners[0], max(least, 0)) if len(winners) == 1 else None

    def _near(self, words: list[str]) -> Iterator[tuple[str, int, int]]:
        bare = [x.rstrip(".") for x in words]
        for key in dict.fromkeys(("".join(bare), "".join(sorted(bare)))):
            found = self.near.get(key)
            if found is None:
                found = self.tree.within(key, allowed(key))
                if len(self.near) < 200_000:
                    self.near[key] = found
            for form, gap in found:
                if gap <= min(allowed(form), allowed(key)):
                    for entity in self.forms[form]:
                        yield form, entity, gap
        # Words cut short with a point, or in another order and misspelled; at least one of them is spelled as known.
        for entity in set().union(*(self.holders.get(x, ()) for x in words)) if len(words) > 1 else ():
            for known in self.words[entity]:
                if len(known) == len(words) > 1 and (gap := _word_gap(words, known)) is not None:
                    yield "".join(known), entity, gap


def spelled_words(lists: list[list[str]]) -> set[str]:
    """Words of the forms of several words, and their first letters with a point, as a word that is cut short has them."""
    whole = {w for words in lists if len(words) > 1 for w in words}
    return whole | {word[:n] + "." for word in whole for n in range(3, len(word))}


def _word_gap(words: list[str], known: list[str]) -> int | None:
    """Edits that turn the words, in any order, into the known ones; a cut word (``Graik.``) costs nothing."""
    left, total = list(known), 0
    for word in sorted(words, key=len, reverse=True):
        if word.endswith(".") and len(word) > 3:
            hits = [(0, x) for x in left if x.startswith(word[:-1])]
        else:
            bare = word.rstrip(".")
            hits = [(edit_distance(bare, x, 2), x) for x in left if abs(len(bare) - len(x)) <= 2]
        if not hits:
            return None
        gap, x = min(hits)
        if gap > (0 if len(x) <= 4 else 2):
            return None
        total += gap
        left.remove(x)
    return total if total <= allowed("".join(known)) else None


def _matchers(entries: pd.DataFrame) -> dict[str, Matcher]:
    return {kind: Matcher([(int(i), n, None if pd.isna(f) else f) for i, n, f in zip(g.entity_id, g["name"], g.full_name)]) for kind, g in entries.groupby("kind")}


_RESULT = "kind string, name string, entity_id long, edits int"
_CANDIDATES = "kind string, name string, entity_id long, edits int, doubt string"
#: Matchers of this Python worker, by the broadcast that holds their entries: built once a worker, not once a task.
_built: dict[str, dict[str, Matcher]] = {}


def _candidate_rows(values: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    """Candidates of one cell of values and entries; typed, whatever is empty."""
    matchers = _matchers(entries)
    rows = [(k, n, e, edits, " ".join(doubts)) for k, n in zip(values.kind, values["name"]) if k in matchers for e, edits, doubts in matchers[k].candidates(n)]
    return pd.DataFrame(rows, columns=["kind", "name", "entity_id", "edits", "doubt"]).astype({"kind": "object", "name": "object", "entity_id": "int64", "edits": "int32", "doubt": "object"})


def _sharded(wanted: DataFrame, entries: DataFrame, shard_size: int, cell_values: int) -> DataFrame:
    """Matches by shards of the reference list: every shard names its candidates, which are settled after the merge.

    A cell joins at most about ``shard_size`` entries of one kind and ``cell_values`` values, whatever the sizes of the
    tables. Words of other entries are known from a table of all words, not of the shard.
    """
    kinds = entries.groupBy("kind").agg(F.ceil(F.count("*") / F.lit(shard_size)).cast("int").alias("shards"))
    spread = wanted.groupBy("kind").agg(F.ceil(F.count("*") / F.lit(cell_values)).cast("int").alias("salts"))
    plan = kinds.join(spread, "kind")
    ref = entries.join(plan, "kind").withColumn("shard", F.pmod(F.xxhash64("entity_id"), "shards")).select("entity_id", "kind", "name", "full_name", "shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    asked = wanted.join(plan, "kind").withColumn("salt", F.pmod(F.xxhash64("name"), "salts").cast("int")).select("kind", "name", "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards").cast("long") - 1)).alias("shard"))
    cell = ["kind", "shard", "salt"]
    near = asked.groupBy(*cell).cogroup(ref.groupBy(*cell)).applyInPandas(lambda a, b: _candidate_rows(a, b), _CANDIDATES)
    near = cut(near, "canonical-candidates")

    def spelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            held = {k: m.holders for k, m in _matchers(pdf).items()}
            yield pd.DataFrame([(k, w) for k, words in held.items() for w in words], columns=["kind", "word"]).astype("object")

    known = entries.mapInPandas(spelled, "kind string, word string").distinct()
    wrong = near.select("kind", "name", "entity_id", "doubt", F.explode(F.split("doubt", " ")).alias("word")).join(known, ["kind", "word"], "left_semi").select("kind", "name", "entity_id", "doubt").distinct()
    kept = near.join(wrong, ["kind", "name", "entity_id", "doubt"], "left_anti")
    # The closest entry is the least of the pairs (edits, id); it is the only one as close if it is the last as well.
    ends = kept.groupBy("kind", "name").agg(F.min(F.struct("edits", "entity_id")).alias("a"), F.min(F.struct("edits", (-F.col("entity_id")).alias("e"))).alias("b"))
    won = ends.where("a.entity_id = -b.e").select("kind", "name", "a.entity_id", F.greatest("a.edits", F.lit(0)).alias("edits"))
    return wanted.join(won, ["kind", "name"], "left")


def map_to_canonical(values: DataFrame, reference: DataFrame, broadcast_limit: int = 50_000, shard_size: int = 20_000, cell_values: int = 20_000) -> DataFrame:
    """Rows of distinct (kind, name) of ``values`` with ``entity_id`` and ``edits`` of the entry meant, else nulls.

    ``reference`` has (entity_id, kind, name, full_name). A value matches the one entry of its kind that is closest in
    spelling, short or long form, with words around it; numbers and size marks have to agree. If two entries are as
    close, the value is unmatched, as are null and blank ones. References of up to ``broadcast_limit`` rows (counted
    here) are one tree a kind, broadcast; longer ones are split into shards, whose candidates are merged and settled
    together, with the same result. Of repeated ids the least name counts. Empty tables and further columns are allowed.
    """
    spark = values.sparkSession
    wanted = values.select("kind", "name").where("kind is not null and name is not null and trim(name) <> ''").distinct()
    rows = reference.select(F.col("entity_id").cast("long").alias("entity_id"), "kind", "name", "full_name").where("entity_id is not null and kind is not null and name is not null")
    entries = rows.groupBy("entity_id").agg(F.min(F.struct("name", "full_name", "kind")).alias("e")).select("entity_id", "e.kind", "e.name", "e.full_name")
    if entries.count() > broadcast_limit:
        return cut(_sharded(wanted, entries, shard_size, cell_values), "canonical-names")
    held, key = spark.sparkContext.broadcast(entries.toPandas()), uuid.uuid4().hex

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if key not in _built:
            _built.clear()
            _built[key] = _matchers(held.value)
        for pdf in batches:
            hits = [m.match(n) if (m := _built[key].get(k)) else None for k, n in zip(pdf.kind, pdf["name"])]
            yield pd.DataFrame({"kind": pdf.kind, "name": pdf["name"], "entity_id": pd.array([h and h[0] for h in hits], dtype="Int64"), "edits": pd.array([h and h[1] for h in hits], dtype="Int32")})

    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return cut(wanted.repartition(parts).mapInPandas(look_up, _RESULT), "canonical-names")


def matched_mentions(mentions: DataFrame, reference: DataFrame, **options: int) -> DataFrame:
    """``(mention_id, kind, name, entity_id, edits)`` of every mention, one row each; entity_id is null where unmatched."""
    rows = mentions.select("mention_id", "kind", "name").distinct()
    return rows.join(map_to_canonical(rows, reference, **options), ["kind", "name"], "left").select("mention_id", "kind", "name", "entity_id", "edits")
