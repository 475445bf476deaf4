"""Set-overlap join: rows and groups that share at least so many items.

Items that few groups hold are looked up: each list gets, for each of its items, the groups that hold it, as
one sorted array of numbers, and counts them where it is. No pair of a list and a group moves by itself.

Lists with an item that many groups hold, and very long ones, are counted through prefixes. Items are
put in one order, rare ones first. Of every list the commonest items are set aside
as long as they weigh less than what must be shared: a pair that shares enough then has
its rarest shared item in front of both cuts. So only the fronts are joined, and an item
that a third of all rows hold makes no pairs by itself. The pairs found are counted in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobloom.operators.lookup import computed_once, list_key
from jobloom.operators.ranking import global_row_number
from jobloom.session import scratch_dir

#: Entries (a group counts as often as it lists the item) of an item that is looked up, and items of a list whose items are.
ITEM_ENTRIES, LIST_ITEMS = 512, 4096


def _front(items: DataFrame, owner: str, weight: str, least: int) -> DataFrame:
    """Items of each owner without the commonest ones that together weigh less than `least`."""
    from_common = Window.partitionBy(owner).orderBy(F.desc("_n"), F.desc("_item"))
    upto = from_common.rowsBetween(Window.unboundedPreceding, 0)
    return items.withColumn("_sum", F.sum(weight).over(upto)).filter(F.col("_sum") >= least).select(owner, "_item")


def _item_sets(rows: DataFrame, items: str) -> DataFrame:
    """Rows with `_own`: their items once each and in order, so that equal sets are equal lists."""
    return rows.withColumn("_own", F.array_sort(F.array_compact(F.array_distinct(items))))


def _key(own: str) -> Column:
    """Half of `list_key`, which travels with every item."""
    return F.substring(list_key(F.col(own)), 1, 16)


def _lists(sets: DataFrame) -> DataFrame:
    """(_list, _own): every set of items that is not empty, once."""
    keyed = computed_once(sets.filter(F.size("_own") > 0).select("_own"), _list=_key("_own"))
    return keyed.dropDuplicates(["_list"]).select("_list", "_own")


def _named(groups: DataFrame, name: str, item: str) -> DataFrame:
    return groups.select(F.col(name).alias("_group"), F.col(item).alias("_item")).dropna()


def _bags(named: DataFrame, group: str) -> DataFrame:
    return named.groupBy(group, "_item").agg(F.count("*").alias("_times"))


def _sides(lists: DataFrame, named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items of the lists (with their greatest weight in a group) and of the groups, both with `_n`, how many lists hold them.

    Items that only one side has can match nothing and are left out.
    """
    bags = _bags(named, "_group")
    own = lists.select("_list", F.explode("_own").alias("_item"))
    known = own.groupBy("_item").agg(F.count("*").alias("_n")).join(bags.groupBy("_item").agg(F.max("_times").alias("_most")), "_item")
    return own.join(known, "_item"), bags.join(known.select("_item", "_n"), "_item")


def _pairs(own: DataFrame, bags: DataFrame, least: int) -> DataFrame:
    """(_list, _group): pairs whose fronts meet."""
    return _front(own, "_list", "_most", least).join(_front(bags, "_group", "_times", least), "_item").select("_list", "_group").distinct()


def overlap_candidates(rows: DataFrame, items: str, groups: DataFrame, name: str, item: str, least: int = 2) -> DataFrame:
    """(_list, _group): the pairs of distinct lists and groups that counting through prefixes looks at."""
    return _pairs(*_sides(_lists(_item_sets(rows, items)), _named(groups, name, item)), least)


def _by_prefixes(lists: DataFrame, named: DataFrame, least: int) -> DataFrame:
    """(_list, _group, matched) of lists with any items."""
    own, bags = _sides(lists, named)
    return (
        _pairs(own, bags, least).join(own.select("_list", "_item"), "_list")
        .join(bags.select("_group", "_item", "_times"), ["_group", "_item"])
        .groupBy("_list", "_group")
        .agg(F.sum("_times").alias("matched"))
        .filter(F.col("matched") >= least)
    )


def _by_lookup(lists: DataFrame, named: DataFrame, common: DataFrame, least: int) -> DataFrame:
    """(_list, _group, matched) of lists without common items: every item brings its groups, and runs of equal ones are counted."""
    rare = named.join(common, "_item", "left_anti")
    numbers = global_row_number(rare.select("_group").distinct(), [F.col("_group")], "_number").withColumn("_number", F.col("_number").cast("int"))
    bags = _bags(rare.join(numbers, "_group"), "_number")
    held = bags.groupBy("_item").agg(F.flatten(F.collect_list(F.array_repeat("_number", F.col("_times").cast("int")))).alias("_held"))
    met = lists.select("_list", F.explode("_own").alias("_item")).join(held, "_item").select("_list", "_held")
    listed = met.repartition("_list").groupBy("_list").agg(F.collect_list("_held").alias("_all"))
    listed = computed_once(listed, ("_all",), _run=F.array_sort(F.flatten("_all")))
    first = F.transform("_run", lambda x, i: F.when((i == 0) | (F.get("_run", i - 1) != x), i))
    listed = computed_once(listed, _first=F.array_compact(first))
    runs = F.transform("_first", lambda at, j: F.struct(
        F.get("_run", at).alias("_number"), (F.coalesce(F.get("_first", j + 1), F.size("_run")) - at).cast("bigint").alias("matched")
    ))
    shared = listed.select("_list", F.inline(F.filter(runs, lambda r: r["matched"] >= least)))
    return shared.join(numbers, "_number").select("_list", "_group", "matched")


def overlap_join(
    rows: DataFrame, key: str, items: str, groups: DataFrame, name: str, item: str, least: int = 2
) -> DataFrame:
    """(key, name, matched): rows and groups with `matched` >= `least`, all of them.

    `items` is an array column, `groups` one row per group and item. `matched` counts the items of a row, each
    once, by how often the group lists them. Null items, groups without a name and null or empty arrays match nothing;
    repeated rows give repeated results. Lists that are equal as sets are worked on once and written to a scratch folder.
    """
    if least < 1:
        raise ValueError("least must be at least 1")
    spark = rows.sparkSession

    def written(df: DataFrame, label: str) -> DataFrame:
        path = scratch_dir(spark, label)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    sets, named = _item_sets(rows.select(key, items), items), _named(groups, name, item)
    lists = written(_lists(sets), "lists")
    # written, so that Spark knows how few they are
    common = written(named.groupBy("_item").agg(F.count("*").alias("_entries")).filter(F.col("_entries") > ITEM_ENTRIES).select("_item"), "common")
    long = F.size("_own") > LIST_ITEMS
    touched = lists.filter(~long).select("_list", F.explode("_own").alias("_item")).join(common, "_item", "left_semi").select("_list").distinct()
    rest = written(touched.unionByName(lists.filter(long).select("_list")), "rest")
    if rest.isEmpty():
        shared = _by_lookup(lists, named, common, least)
    else:
        shared = _by_lookup(lists.join(rest, "_list", "left_anti"), named, common, least).unionByName(
            _by_prefixes(lists.join(rest, "_list", "left_semi"), named, least)
        )
    found = sets.withColumn("_list", _key("_own")).join(shared, "_list")
    return found.select(key, F.col("_group").alias(name), "matched")
