"""Logs of corrections over tables: last writer wins, full folds, slice replacement, snapshots."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions import scalars as S


def last_writer(log: DataFrame, keys: list[str], order: str, *columns: str) -> DataFrame:
    """The last entry of each key."""
    return log.groupBy(*keys).agg(*[F.max_by(c, order).alias(c) for c in columns])


def replace_slice(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """new, and the rows of old in slices (values of keys) that new does not have."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def first_of_group(df: DataFrame, keys: list[str], order: Column, *columns: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.min_by(c, order).alias(c) for c in columns])


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """key and status: unchanged, changed, orphan (only in old) or added (only in new), by a fingerprint column."""
    a, b = old.select(key, F.col(value).alias("a_")), new.select(key, F.col(value).alias("b_"))
    status = F.when(F.col("b_").isNull(), "orphan").when(F.col("a_").isNull(), "added").when(F.col("a_") == F.col("b_"), "unchanged").otherwise("changed")
    return a.join(b, key, "full_outer").select(key, status.alias("status"))


#: How much of a box an action must cover to concern it (IoU above): targets settle on what is roughly there.
THERE, PINNED = 0.5, 0.3
BOX = ("x0", "y0", "x1", "y1")


def _row(box: Column, target: Column, forbid: Column) -> Column:
    return F.struct(*[box[c].alias(c) for c in BOX], target.alias("target"), forbid.alias("forbid"))


def _apply(rows: Column, act: Column) -> Column:
    """A page's rows after one action, which is an effect on the rows that its box meets."""
    none = F.lit(None).cast("long")
    nothing = F.array().cast("array<bigint>")
    meets = lambda least: lambda r: S.iou(r, act) > least
    forbidden = F.transform(rows, lambda r: F.when(meets(THERE)(r), _row(r, F.when(~r["target"].eqNullSafe(act["target"]), r["target"]), F.array_append(r["forbid"], act["target"]))).otherwise(r))
    gone = F.filter(rows, lambda r: ~meets(THERE)(r))
    first = F.array_position(F.transform(rows, meets(PINNED)), True)
    pinned = F.when(first > 0, F.transform(rows, lambda r, i: F.when(i + 1 == first, _row(act, act["target"], r["forbid"])).otherwise(r))).otherwise(F.array_append(rows, _row(act, act["target"], nothing)))
    added = F.when(F.exists(rows, meets(THERE)), rows).otherwise(F.array_append(rows, _row(act, none, nothing)))
    verb, named = act["action"], act["target"].isNotNull()
    return F.when(verb == "not", forbidden).when(verb == "reject", gone).when(verb.isin("assign", "add", "locked") & named, pinned).when(verb == "add", added).otherwise(rows)


def overlay(boxes: DataFrame, actions: DataFrame, keys: list[str], locked: DataFrame | None = None) -> DataFrame:
    """keys, box, target, forbid of every page's boxes after its actions in their order, and then its locked rows.

    boxes: keys, x0, y0, x1, y1; actions: keys, ord, action, x0, y0, x1, y1, target; locked: keys, x0, y0, x1, y1, target.
    not: what is there may not have that target, and gives it up if it has it. reject: what is there goes. assign, or add with a
    target: the first row in its place takes box and target, or a new one is put in. add without a target: a new row if none is
    there. locked: as assign. Other verbs do nothing; rows and actions of one page in the order of (ord, y0, x0, y1, x1, action, target).

    A page is a bounded unit, so its rows meet in one array and the actions are folded over it.
    """
    base = boxes.select(*keys, F.lit(0).alias("kind"), F.lit(None).cast("long").alias("ord"), F.lit("").alias("action"), *BOX, F.lit(None).cast("long").alias("target"))
    acts = actions.select(*keys, F.lit(1).alias("kind"), "ord", "action", *BOX, "target")
    both = base.unionByName(acts)
    if locked is not None:
        both = both.unionByName(locked.select(*keys, F.lit(2).alias("kind"), F.lit(None).cast("long").alias("ord"), F.lit("locked").alias("action"), *BOX, "target"))
    pages = both.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("kind", "ord", "y0", "x0", "y1", "x1", "action", "target"))).alias("all"))
    start = F.transform(F.filter("all", lambda r: r["kind"] == 0), lambda r: _row(r, r["target"], F.array().cast("array<bigint>")))
    done = F.aggregate(F.filter("all", lambda r: r["kind"] > 0), start, _apply)
    return pages.select(*keys, F.inline(done))


def _placed(act: Column, rules: Column) -> Column:
    """The column that an action's middle lies in, counted from the right, between the page's rules (rising); null outside of them."""
    before = F.size(F.filter(rules, lambda r: r <= (act["x0"] + act["x1"]) / 2))
    return F.when((before > 0) & (before < F.size(rules)), (F.size(rules) - before).cast("long"))


FIELDS = {"column": "bigint", "kind": "string", "target": "bigint", "forbid": "array<bigint>", "locked": "bigint"}


def _seal(box: Column, **fields) -> Column:
    return F.struct(*[box[c].cast("long").alias(c) for c in BOX], *[fields[c].cast(t).alias(c) for c, t in FIELDS.items()])


def _with(row: Column, **fields) -> Column:
    """A page's row with some fields changed."""
    return _seal(fields.pop("box", row), **{c: fields.get(c, row[c]) for c in FIELDS})


MARKED = ("n", "ord", "action", *BOX, "target", "ident")


def _bound(value: Column, of) -> Column:
    """of(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def _ruled(state: Column, act: Column, rules: Column) -> Column:
    """A page's rows, and its actions so far with whether they took effect, after one action."""
    rows = state["rows"]
    meets = lambda least: lambda r: S.iou(r, act) > least
    first_there = F.struct(F.coalesce(F.array_position(F.transform(rows, meets(PINNED)), True), F.lit(0)).alias("first"), F.exists(rows, meets(THERE)).alias("there"), _placed(act, rules).alias("at"))
    return _bound(first_there, lambda met: _effect(state, act, met, meets))


def _effect(state: Column, act: Column, met: Column, meets) -> Column:
    """What _ruled gives; met: the first row that the action meets, whether it meets any by more than a half, and its column."""
    rows, target, verb = state["rows"], act["target"], act["action"]
    first, there, at = met["first"], met["there"], met["at"]
    none, kind = F.lit(None), F.when(verb == "locked", "approved").otherwise("manual")
    forbidden = F.transform(rows, lambda r: F.when(meets(THERE)(r), _with(r, target=F.when(~r["target"].eqNullSafe(target), r["target"]), forbid=F.array_append(r["forbid"], target))).otherwise(r))
    gone = F.filter(rows, lambda r: ~meets(THERE)(r))
    put = lambda t: F.concat(rows, F.array(_seal(act, column=at, kind=kind, target=t, forbid=F.array(), locked=none)))
    pinned = F.when(first > 0, F.transform(rows, lambda r, i: F.when(i + 1 == first, _with(r, box=act, target=target, kind=kind)).otherwise(r))).when(at.isNotNull(), put(target)).otherwise(rows)
    held = F.transform(pinned, lambda r: F.when((r["kind"] == "approved") & r["target"].eqNullSafe(target), _with(r, locked=act["ident"])).otherwise(r))
    named, bare = verb.isin("assign", "add", "locked") & target.isNotNull(), (verb == "add") & target.isNull()
    now = F.when(verb == "not", forbidden).when(verb == "reject", gone).when(named & (verb == "locked"), held).when(named, pinned).when(bare & ~there & at.isNotNull(), put(none)).otherwise(rows)
    used = F.when(verb.isin("not", "reject"), there).when(named, (first > 0) | at.isNotNull()).when(bare, ~there & at.isNotNull()).otherwise(False)
    marked = F.struct(*[act[c].alias(c) for c in MARKED], used.alias("used"))
    return F.struct(now.alias("rows"), F.array_append(state["acts"], marked).alias("acts"))


def ruled_pages(boxes: DataFrame, actions: DataFrame, rules: DataFrame, keys: list[str], locked: DataFrame | None = None) -> DataFrame:
    """keys, rows and acts of every page: its rows after its actions in their order and then its locked rows, and all of these actions with whether they took effect.

    boxes: keys, x0, y0, x1, y1, column, kind; actions: keys, ord, action, x0, y0, x1, y1, target; locked: keys, ident, x0, y0, x1, y1, target;
    rules: keys, rules (rising places between which the page's columns lie), one row a page. Rows hold the box, column, kind, target (null: none), forbid and
    locked (the ident of a locked row); acts hold n (from 1), ord, action, box, target, ident and used.

    not: what an action's box meets by more than a half may not have its target, and gives it up if it has it. reject: what it meets so goes.
    assign, or add with a target: the first row met by more than 0.3 takes box and target and becomes manual; if there is none, a new row
    goes into the column that the box's middle lies in, and outside all columns nothing happens. add without a target: a new row if none is met by more than a half
    and a column holds its middle. locked: as assign, but the row becomes approved, and approved rows of its target take its ident. Other verbs, and assign without a target, do nothing.
    An action took effect if it met, changed or put in a row; an effect may repeat what was so before.

    Actions of one page are taken in the order of (ord, y0, x0, y1, x1, action, target); a page without rules has no columns; pages of
    actions alone begin empty. A page is a bounded unit, so its rows meet in one array and the actions are folded over it.
    """
    none = {"ord": "long", "action": "string", "target": "long", "column": "long", "kind": "string", "ident": "long"}
    names = ["ord", *BOX, "action", "target", "column", "kind", "ident"]
    lack = lambda df, part, **given: df.select(*keys, F.lit(part).alias("part"), *[given[c].cast(none[c]).alias(c) if c in given else F.col(c).cast(none.get(c, "long")).alias(c) if c in df.columns else F.lit(None).cast(none[c]).alias(c) for c in names])
    both = lack(boxes, 0, ord=F.lit(None)).unionByName(lack(actions, 1))
    if locked is not None:
        both = both.unionByName(lack(locked, 2, ord=F.lit(None), action=F.lit("locked")))
    order = ["part", "ord", "y0", "x0", "y1", "x1", "action", "target", "column", "kind", "ident"]
    pages = both.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order))).alias("all")).join(rules.select(*keys, "rules"), keys, "left")
    rows = F.transform(F.filter("all", lambda r: r["part"] == 0), lambda r: _seal(r, column=r["column"], kind=r["kind"], target=r["target"], forbid=F.array(), locked=F.lit(None)))
    acts = F.transform(F.filter("all", lambda r: r["part"] > 0), lambda r, i: r.withField("n", (i + 1).cast("long")))
    pages = pages.select(*keys, rows.alias("rows"), acts.alias("acts"), F.coalesce("rules", F.array().cast("array<bigint>")).alias("rules"))
    # the fold itself marks the actions: what refers to its result from within a lambda would run it again for every action
    none_yet = F.filter(F.transform("acts", lambda a: F.struct(*[a[c].alias(c) for c in MARKED], F.lit(False).alias("used"))), lambda a: F.lit(False))
    done = F.aggregate("acts", F.struct(F.col("rows"), none_yet.alias("acts")), lambda state, act: _ruled(state, act, F.col("rules")))
    return pages.select(*keys, done.alias("done")).select(*keys, F.col("done.rows").alias("rows"), F.col("done.acts").alias("acts"))


def _each(pages: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The structs of an array one by one. The outer form, as before the inner one Spark asks for arrays with elements, which runs the fold again."""
    return pages.select(*keys, F.explode_outer(name).alias("r_")).filter("r_ is not null").select(*keys, "r_.*")


def ruled_rows(pages: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ruled_pages, one by one."""
    return _each(pages, keys, "rows")


def ruled_actions(pages: DataFrame, keys: list[str]) -> DataFrame:
    """The actions of ruled_pages, one by one; those that are not used had no effect."""
    return _each(pages, keys, "acts")


def forbidden_pairs(rows: DataFrame, ident: list[str], scores: DataFrame, target: str, score: str) -> DataFrame:
    """scores(ident, target, score) with -1 for the targets in the row's forbid."""
    bad = rows.select(*ident, F.explode("forbid").alias(target)).distinct().withColumn("bad_", F.lit(True))
    return scores.join(bad, [*ident, target], "left").withColumn(score, F.when(F.col("bad_"), F.lit(-1.0)).otherwise(F.col(score))).drop("bad_")
