"""Dictionaries: inversion, overrides, longest-match conversion, look-ups, character classes."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pairs(df: DataFrame, key: str, values: str) -> DataFrame:
    """The inverted index, one row (value, k) for each value of a key, from a column of blank-separated values: no value's keys meet in one row."""
    return df.select(F.col(key).alias("k"), F.explode(F.split(values, " ")).alias("value")).filter("value != ''").distinct()


def invert(df: DataFrame, key: str, values: str) -> DataFrame:
    """value, n_keys and first_key, its smallest key; pairs() has all keys."""
    return pairs(df, key, values).groupBy("value").agg(F.count("*").alias("n_keys"), F.min("k").alias("first_key"))


def min_with_override(candidates: DataFrame, prefer: DataFrame, key: str, value: str) -> DataFrame:
    """The smallest value of each key, or the preferred one; preferences may add keys."""
    low = candidates.groupBy(key).agg(F.min(value).alias("low_"))
    want = prefer.groupBy(key).agg(F.min(value).alias("want_"))
    return low.join(want, key, "full_outer").select(key, F.coalesce("want_", "low_").alias(value))


def longest_match(text: Column, entries: dict[str, str], longest: int) -> Column:
    """Text with its keys converted from left to right, at each place the longest key that fits; other characters stay.

    entries: a small dictionary (a map literal in the plan). For large ones, or long texts, use convert_broadcast.
    """
    table = F.create_map(*[F.lit(x) for kv in entries.items() for x in kv])
    places = F.sequence(F.lit(1), F.length(text))

    def step(acc, p):
        found = F.coalesce(*[F.when(F.try_element_at(table, F.substring(text, p, F.lit(n))).isNotNull() & (F.length(F.substring(text, p, F.lit(n))) == n), F.struct(F.lit(n).alias("n"), F.try_element_at(table, F.substring(text, p, F.lit(n))).alias("v"))) for n in range(longest, 0, -1)], F.struct(F.lit(1).alias("n"), F.substring(text, p, F.lit(1)).alias("v")))
        return F.when(p < acc["next"], acc).otherwise(F.struct((p + found["n"]).alias("next"), F.concat(acc["out"], found["v"]).alias("out")))

    start = F.struct(F.lit(1).alias("next"), F.lit("").alias("out"))
    return F.when(F.length(text) == 0, F.lit("")).otherwise(F.aggregate(places, start, step)["out"])


MOST_KEYS = 5_000_000  # of a dictionary that is shared with every worker: some hundred MB as a trie
CHARS = 1 << 20  # that are converted side by side
END = 0x1FFFFF  # stands between texts; no character has this code


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """arange(s, s + n) of all pairs in a row."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class Trie:
    """A dictionary as sorted edges (node << 21 | character): the edge at place k leads to node k + 1, and nodes are numbered level by level."""

    def __init__(self, entries: dict[str, str]):
        keys = [k for k in entries if k]
        size = np.fromiter(map(len, keys), np.int64, len(keys))
        codes, first, node, edges = _codes(keys), np.cumsum(size) - size, np.zeros(len(keys), np.int64), []
        self.longest, base = int(size.max(initial=0)), 0
        for depth in range(self.longest):
            on = size > depth
            level, child = np.unique(node[on] << 21 | codes[first[on] + depth], return_inverse=True)
            node[on], base = base + child + 1, base + len(level)
            edges.append(level)
        self.edges = np.concatenate([np.zeros(0, np.int64), *edges])
        self.entry = np.full(base + 1, -1)  # of each node the key that ends there
        self.entry[node] = np.arange(len(keys))
        values = [entries[k] for k in keys]
        self.size = np.fromiter(map(len, values), np.int64, len(values))
        self.values, self.first = _codes(values), np.cumsum(self.size) - self.size

    def matches(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Length (0: none) and number of the longest key that begins at each place: all places go down the trie together."""
        length, entry = np.zeros(len(codes), np.int64), np.full(len(codes), -1)
        at, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        for depth in range(self.longest):
            inside = at + depth < len(codes)
            at, node = at[inside], node[inside]
            edge = node << 21 | codes[at + depth]
            place = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
            hit = self.edges[place] == edge
            at, node = at[hit], place[hit] + 1
            ends = self.entry[node] >= 0
            length[at[ends]], entry[at[ends]] = depth + 1, self.entry[node[ends]]
        return length, entry

    def convert(self, codes: np.ndarray) -> np.ndarray:
        """The codes with the longest key at each place, from left to right, by its value."""
        length, entry = self.matches(codes)
        covered = np.zeros(len(codes) + 1, np.int64)
        end, long = 0, np.flatnonzero(length > 1)
        for p, n in zip(long.tolist(), length[long].tolist()):  # only a key of two signs or more covers other places
            if p >= end:
                end = p + n
                covered[p + 1] += 1
                covered[end] -= 1
        starts = np.cumsum(covered[:-1]) == 0
        keyed = entry >= 0
        size, source = np.ones(len(codes), np.int64), np.arange(len(codes))
        size[keyed], source[keyed] = self.size[entry[keyed]], len(codes) + self.first[entry[keyed]]
        return np.concatenate([codes, self.values])[_ranges(source[starts], size[starts])]


def convert_texts(texts: list[str], tries: list[Trie]) -> list[str]:
    """All texts through all tries in turn."""
    codes = np.insert(_codes(texts), np.cumsum([len(t) for t in texts]), END)
    for trie in tries:
        codes = trie.convert(codes)
    ends = np.flatnonzero(codes == END)
    letters = np.delete(codes, ends).astype("<u4").tobytes()
    cuts = (4 * (ends - np.arange(len(ends)))).tolist()
    return [letters[a:b].decode("utf-32-le", "surrogatepass") for a, b in zip([0, *cuts], cuts)]


def _converted(df: DataFrame, text: str, tries: list[Trie], name: str) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(tries)

    @F.pandas_udf("string")
    def convert(texts: pd.Series) -> pd.Series:
        whole = texts.dropna()
        size = whole.map(len).cumsum()
        parts = [part.tolist() for _, part in whole.groupby(size // CHARS)]
        return pd.Series([c for part in parts for c in convert_texts(part, shared.value)], whole.index, dtype=object).reindex(texts.index)

    return df.withColumn(name, convert(text))


def convert_broadcast(df: DataFrame, text: str, entries: dict[str, str], name: str) -> DataFrame:
    """Adds `name`: longest_match of a column of texts of any length (null stays null), with a dictionary of any size that fits a worker."""
    return _converted(df, text, [Trie(entries)], name)


_BLANKS = r"[\s\x1C-\x1F\x85\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]+"


def dictionary(lines: DataFrame, order: str = "n", line: str = "line") -> DataFrame:
    """key and value of a text dictionary's lines, `key<tab>values`: the first of a key's values (blanks are between them), of its last line.

    Lines that begin with # or have no tab, or no value behind it, are passed over.
    """
    entries = _entries(lines, order, line)
    return entries.groupBy("key").agg(F.max_by(F.get("values", F.lit(0)), "n").alias("value"))


def _entries(lines: DataFrame, order: str, line: str) -> DataFrame:
    parts = F.split(line, "\t")
    values = F.filter(F.split(F.get(parts, F.lit(1)), _BLANKS), lambda v: v != "")
    kept = lines.filter(~F.startswith(F.col(line), F.lit("#")) & F.contains(F.col(line), F.lit("\t")))
    return kept.select(F.get(parts, F.lit(0)).alias("key"), values.alias("values"), F.col(order).alias("n")).filter(F.size("values") > 0)


def reversed_dictionary(lines: DataFrame, order: str = "n", line: str = "line") -> DataFrame:
    """key and value of the dictionary read the other way: every value leads to its first key in the order of lines, unless a line
    `# @reverse-prefer: value key` names another one (the last such line counts, and may name values that no entry has)."""
    first = _entries(lines, order, line).select(F.explode("values").alias("key"), F.col("key").alias("k"), "n").groupBy("key").agg(F.min_by("k", "n").alias("first_"))
    said = F.filter(F.split(F.regexp_replace(line, "^[^:]*:", ""), _BLANKS), lambda v: v != "")
    prefer = lines.filter(F.startswith(F.col(line), F.lit("# @reverse-prefer:"))).select(said.alias("s"), F.col(order).alias("n")).groupBy(F.get("s", F.lit(0)).alias("key")).agg(F.max_by(F.get("s", F.lit(1)), "n").alias("want_"))
    return first.join(prefer, "key", "full_outer").select("key", F.coalesce("want_", "first_").alias("value"))


def merged(low: DataFrame, high: DataFrame) -> DataFrame:
    """Two dictionaries as one; the second one's values go before the first one's."""
    return low.select("key", F.col("value").alias("low_")).join(high.select("key", F.col("value").alias("high_")), "key", "full_outer").select("key", F.coalesce("high_", "low_").alias("value"))


def _trie(table: DataFrame) -> Trie:
    rows = table.select("key", "value").limit(MOST_KEYS + 1).toArrow()  # a dictionary is shared whole or not at all
    if rows.num_rows > MOST_KEYS:
        raise ValueError(f"a dictionary of more than {MOST_KEYS} keys is not shared with every worker")
    return Trie(dict(zip(rows.column("key").to_pylist(), rows.column("value").to_pylist())))


def convert_chain(df: DataFrame, text: str, stages: list[DataFrame], name: str, fallback: DataFrame | None = None) -> DataFrame:
    """Adds `name`: the text through the dictionaries (key, value; keys are unique) in turn, each from left to right by the longest key that fits.

    fallback: a map of single characters in place of the chain where its last dictionary is empty. Null texts stay null. Tries are built
    once, on the driver, from at most MOST_KEYS keys a stage, and shared.
    """
    tries = [_trie(s) for s in stages]
    if fallback is not None and not tries[-1].longest:
        tries = [_trie(fallback.filter(F.length("key") == 1))]
    return _converted(df, text, [t for t in tries if t.longest], name)


def resolve(wanted: DataFrame, names: DataFrame, word: str, ident: str, name: str) -> DataFrame:
    """For each wanted word the number of names that hold it as a word, and the smallest id: none, one or many."""
    words = names.select(F.col(ident).alias("id_"), F.explode(F.array_distinct(F.split(name, " "))).alias("w_"))
    hit = wanted.join(words, F.col(word) == F.col("w_"), "left").groupBy(word).agg(F.count("id_").alias("n"), F.min("id_").alias("first_id"))
    return hit.withColumn("outcome", F.when(F.col("n") == 0, "none").when(F.col("n") == 1, "one").otherwise("many"))


def class_counts(text: Column, classes: dict[str, str]) -> list[Column]:
    """Number of characters of each class (a regular-expression class) in a text."""
    return [(F.length(text) - F.length(F.regexp_replace(text, f"[{c}]", ""))).cast("long").alias(k) for k, c in classes.items()]
