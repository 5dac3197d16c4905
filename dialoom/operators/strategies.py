"""Translation strategies: how the texts of a value are found, and how their translations make a value again.

A strategy is two expressions over one row. Between them the texts of all rules and rows go through one translation stage, where
equal requests are sent once: lists as one marked text, or in marked batches if that is too long, or item by item where the
markers came back damaged; single texts in chunks. Answers are written before anything is made of them (see AnswerLog).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, AtomicType, DataType, MapType, StringType, StructType

from ..functions import text as T
from . import nested
from .answers import AnswerLog
from .pairs import Rule, leaves
from .translate import action_logs, passes_guards, suspicious_unchanged

#: Characters of a request, at most, unless a rule says otherwise.
MAX_CHARS = 2500
TURNS = "array<map<string,variant>>"


@dataclass(frozen=True)
class Strategy:
    """texts, value: (type, value, options, ...) -> Column. accepts: (type, options) -> what is wrong with the column, or "". broken: a row's value that does not fit."""

    texts: Callable[[DataType, Column, dict], Column]
    value: Callable[[DataType, Column, dict, Column], Column]
    accepts: Callable[[DataType, dict], str]
    broken: Callable[[Column, dict], Column] | None = None
    as_list: bool = True  # texts belong together and go as one marked text
    retries: bool = True  # an English text that came back the same is sent again where a rule asks for it
    of_texts: bool = False  # the value is made of the translations alone


REGISTRY: dict[str, Strategy] = {}


def register_strategy(name: str, strategy: Strategy) -> None:
    REGISTRY[name] = strategy


def blank_as_empty(items: Column) -> Column:
    return F.transform(items, lambda x: F.coalesce(x.cast("string"), F.lit("")))


def scalar(kind: DataType, _: dict) -> str:
    return "" if isinstance(kind, AtomicType) else "a scalar text-like value is needed"


def string(kind: DataType, _: dict) -> str:
    return "" if isinstance(kind, StringType) else "a string is needed"


def list_of_scalars(kind: DataType, _: dict) -> str:
    return "" if isinstance(kind, ArrayType) and isinstance(kind.elementType, AtomicType) else "a list of scalars is needed"


def list_of_turns(kind: DataType, options: dict) -> str:
    content = options.get("content_field", "content")
    turn = kind.elementType if isinstance(kind, ArrayType) else None
    if isinstance(turn, MapType) or isinstance(turn, StructType) and content in turn.names:
        return ""
    return f"a list of turns with {content!r} is needed"


def structure(kind: DataType, _: dict) -> str:
    return "" if isinstance(kind, (StructType, ArrayType)) else "a mapping or a list is needed"


def structure_with_paths(kind: DataType, options: dict) -> str:
    return structure(kind, options) if options.get("paths") else "options.paths must name at least one path"


def contents(_: DataType, turns: Column, options: dict) -> Column:
    content = options.get("content_field", "content")
    text = lambda t: F.coalesce(t[content].cast("string"), F.lit(""))
    if options.get("normalize_newlines", True):
        return F.transform(turns, lambda t: T.strip(F.regexp_replace(text(t), r"\r\n|\r|\n", " ")))
    return F.transform(turns, text)


def turns_with(kind: DataType, turns: Column, options: dict, new: Column) -> Column:
    content = options.get("content_field", "content")
    both = F.arrays_zip(turns.alias("t"), new.alias("x"))
    if isinstance(kind.elementType, MapType):
        return F.transform(both, lambda p: F.map_concat(F.map_filter(p["t"], lambda k, _: k != content), F.create_map(F.lit(content), p["x"])))
    return F.transform(both, lambda p: p["t"].withField(content, p["x"]))


def json_contents(_: DataType, dialog: Column, options: dict) -> Column:
    content = options.get("content_field", "content")
    return F.transform(F.from_json(dialog, TURNS), lambda t: F.coalesce(F.try_variant_get(t[content], "$", "string"), F.lit("")))


def json_turns_with(_: DataType, dialog: Column, options: dict, new: Column) -> Column:
    target = options.get("target_content_field", "content_fr")
    both = F.arrays_zip(F.from_json(dialog, TURNS).alias("t"), new.alias("x"))
    said = lambda p: F.create_map(F.lit(target), p["x"].cast("variant"))
    return F.to_json(F.transform(both, lambda p: F.map_concat(F.map_filter(p["t"], lambda k, _: k != target), said(p))))


def bad_json_turns(dialog: Column, options: dict) -> Column:
    content, turns = options.get("content_field", "content"), F.from_json(dialog, TURNS)
    lacking = F.exists(turns, lambda t: ~F.map_contains_key(t, content))
    return F.when(turns.isNull(), "a JSON list of turns is needed").when(lacking, f"every turn needs {content!r}")


def bad_json_list(items: Column, _: dict) -> Column:
    parsed = F.from_json(items, "array<variant>")
    inner = F.exists(parsed, lambda x: F.schema_of_variant(x).rlike("^(?:ARRAY|OBJECT)"))
    return F.when(parsed.isNull(), "a JSON list is needed").when(inner, "only scalar items are allowed")


def entity_texts(_: DataType, value: Column, options: dict) -> Column:
    whole = F.coalesce(value, F.lit(""))
    parts = T.entity_parts(whole, options.get("separator", " <S> "))
    return F.array(F.when(parts.isNull(), whole).otherwise(parts[2]))


def entity_with(_: DataType, value: Column, options: dict, new: Column) -> Column:
    separator = options.get("separator", " <S> ")
    parts = T.entity_parts(value, separator)
    return F.when(parts.isNull(), new[0]).when(T.is_blank(parts[2]), value).otherwise(F.concat_ws(separator, parts[0], parts[1], new[0]))


def labels(entries: Column, new: Column) -> Column:
    """The translations by the labels of their places."""
    return F.map_from_arrays(F.transform(entries, lambda e: e["path"]), new)


def nested_entries(kind: DataType, value: Column, options: dict) -> Column:
    return nested.texts_at_paths(kind, value, [p for p in options["paths"] if p.strip()])


def nested_with(kind: DataType, value: Column, options: dict, new: Column) -> Column:
    steps = [nested.segments(p) for p in dict.fromkeys(options["paths"])]
    return nested.replaced(kind, value, steps, F.lit(""), labels(nested_entries(kind, value, options), new))


def deep_entries(kind: DataType, value: Column, options: dict) -> Column:
    return leaves(kind, value, exclude=frozenset(options.get("exclude_keys", ())))


def deep_with(kind: DataType, value: Column, options: dict, new: Column) -> Column:
    exclude = frozenset(options.get("exclude_keys", ()))
    return nested.replaced_leaves(kind, value, F.lit(""), labels(deep_entries(kind, value, options), new), exclude)


def of_entries(entries: Callable) -> Callable:
    return lambda kind, value, options: F.transform(entries(kind, value, options), lambda e: e["text"])


register_strategy("text", Strategy(lambda k, v, o: F.array(F.coalesce(v.cast("string"), F.lit(""))), lambda k, v, o, new: new[0], scalar, as_list=False, of_texts=True))
register_strategy("text_list", Strategy(lambda k, v, o: blank_as_empty(v), lambda k, v, o, new: new, list_of_scalars))
register_strategy("dialog_turns_content", Strategy(contents, turns_with, list_of_turns))
register_strategy("serialized_dialog_turns_content", Strategy(json_contents, json_turns_with, string, bad_json_turns, retries=False))
register_strategy("serialized_text_list", Strategy(lambda k, v, o: blank_as_empty(F.from_json(v, "array<string>")), lambda k, v, o, new: F.to_json(new), string, bad_json_list))
register_strategy("structured_entity", Strategy(entity_texts, entity_with, string, as_list=False, retries=False))
register_strategy("nested_text_fields", Strategy(of_entries(nested_entries), nested_with, structure_with_paths, retries=False))
register_strategy("deep_map_texts", Strategy(of_entries(deep_entries), deep_with, structure, retries=False))


register_strategy("weblinx_query", Strategy(lambda k, v, o: F.array(), lambda k, v, o, new: v, scalar))


def problems(rows: DataFrame, rules: list[Rule]) -> list[str]:
    """What is wrong with rules and columns, before any job is run."""
    out = []
    for rule in rules:
        if rule.strategy not in REGISTRY:
            out.append(f"unknown translation strategy: {rule.strategy}")
        elif rule.source not in rows.columns:
            out.append(f"column {rule.source!r} is missing")
        elif said := REGISTRY[rule.strategy].accepts(rows.schema[rule.source].dataType, rule.options):
            out.append(f"field {rule.source!r} with strategy {rule.strategy!r}: {said}")
    return out


def marked_batches(items: Column, most: int) -> Column:
    """array<array<string>>: items in order, as many in each batch as their marked text has room for; an item too long is a batch of its own."""
    empty = F.array().cast("array<string>")
    size = lambda i, x: F.char_length(x) + F.char_length(i.cast("string")) + 5  # noqa: E731  "@@i@@ item" and what parts it from the next
    state = lambda done, last, n: F.struct(done.alias("done"), last.alias("last"), n.alias("n"))
    closed = lambda s: F.when(F.size(s["last"]) == 0, s["done"]).otherwise(F.concat(s["done"], F.array(s["last"])))
    if most <= 0:
        return F.when(F.size(items) > 0, F.array(items)).otherwise(F.array().cast("array<array<string>>"))
    start = state(F.array().cast("array<array<string>>"), empty, F.lit(0))

    def step(s, x):
        cost = size(F.size(s["last"]), x) + F.when(F.size(s["last"]) > 0, 1).otherwise(0)
        fits = (F.size(s["last"]) == 0) | (s["n"] + cost <= most)
        return F.when(fits, state(s["done"], F.concat(s["last"], F.array(x)), s["n"] + cost)).otherwise(state(closed(s), F.array(x), size(F.lit(0), x)))

    return F.aggregate(items, start, step, closed)


def in_order(*field) -> Column:
    """x of structs whose first fields say its place, as a list."""
    return F.transform(F.sort_array(F.collect_list(F.struct(*field))), lambda p: p["x"])


def by_size(column: str, sizes: list[int], f: Callable[[int], Column]) -> Column:
    """f(most) for the row's own `most`, one of a few."""
    out = f(sizes[0])
    for most in sizes[1:]:
        out = F.when(F.col(column) == most, f(most)).otherwise(out)
    return out


def noted() -> Column:
    """What is said of a chunk that failed."""
    return F.when(F.col("status") == "error", F.concat(F.lit("item "), F.col("i").cast("string"), F.lit(" chunk "), F.col("c").cast("string"), F.lit(": "), F.col("error")))


def translated_items(lists: DataFrame, translator: str, sizes: list[int], answers: AnswerLog, keys: tuple[str, ...], together: tuple[str, ...], **policy) -> DataFrame:
    """As `translated_lists`, item by item and chunk by chunk. Texts are moved three times: to be asked for once, to their places, and to the rows (of equal `together`); what a step has shuffled or needed is gone before the next one."""
    batches = lists.select(*keys, "most", F.posexplode(by_size("most", sizes, lambda most: marked_batches(F.col("items"), most))).alias("b", "batch"))
    items = batches.select(*keys, "most", "b", F.posexplode("batch").alias("i", "item")).withColumn("blank", T.is_blank(F.col("item")))
    cut = F.when(F.col("blank"), F.array("item")).otherwise(by_size("most", sizes, lambda most: T.chunks(F.col("item"), most)))
    pieces = items.select(*keys, "b", "i", "blank", F.posexplode(cut).alias("c", "text")).withColumn("key", F.when(~F.col("blank"), answers.key("text", translator, **policy)))
    at = (*keys, "b", "i", "c")
    with answers.kept(pieces) as written:
        answers.send(answers.unanswered(written.where("key is not null").select("key", "text")), translator, **policy)
        places = answers.keep(written.select(*at, "key", F.when(F.col("blank"), F.col("text")).alias("said")))
    answered = answers.told(places.where("key is not null").drop("said")).drop("key")
    found = answers.keep(answered.unionByName(places.where("key is null").select(*at, "said"), allowMissingColumns=True))
    by_item = found.repartition(*together).groupBy(*keys, "b", "i").agg(
        F.array_join(in_order("c", F.col("said").alias("x")), "").alias("x"),
        F.concat_ws("; ", F.array_sort(F.collect_list(noted()))).alias("error"), F.sum("attempts").alias("tries"),
    )
    by_batch = by_item.groupBy(*keys, "b").agg(in_order("i", "x").alias("x"), F.concat_ws("; ", F.array_sort(F.collect_list(F.when(F.col("error") != "", F.col("error"))))).alias("error"), F.coalesce(F.sum("tries"), F.lit(0)).alias("tries"))
    return by_batch.groupBy(*keys).agg(F.flatten(in_order("b", "x")).alias("done"), F.concat_ws("; ", in_order("b", F.when(F.col("error") != "", F.col("error")).alias("x"))).alias("error"), F.sum("tries").alias("attempts"))


def translated_lists(lists: DataFrame, translator: str, sizes: list[int], answers: AnswerLog, keys: tuple[str, ...] = ("split", "row_idx"), **policy) -> DataFrame:
    """keys, items, most (one of `sizes`: characters of a request) -> keys, done (as many texts), error, attempts. Equal requests are sent once."""
    batches = lists.select(*keys, "most", F.posexplode(by_size("most", sizes, lambda most: marked_batches(F.col("items"), most))).alias("b", "batch"))
    # blank items have no translation to parse; a list with one goes item by item
    room = by_size("most", sizes, lambda most: F.lit(most if most > 0 else 2**31 - 1))
    sendable = ~F.exists("batch", lambda x: T.is_blank(x)) & (F.char_length(T.marked_text(F.col("batch"))) <= room)
    marked = batches.withColumn("marked", F.when(sendable, T.marked_text(F.col("batch"))))
    told = answers.ask(marked, translator, column="marked", **policy)
    sent = marked.join(told.select(F.col("text").alias("marked"), "translation", F.col("attempts").alias("tries"), F.col("error").alias("refused")), "marked", "left")
    parsed = T.parse_marked(F.col("translation"))
    whole = answers.keep(sent.withColumn("whole", F.when(F.size(parsed) == F.size("batch"), parsed)).drop("marked", "translation"))
    # what came back damaged, item by item and chunk by chunk
    items = whole.where("whole is null").select(*keys, "most", "b", F.posexplode("batch").alias("i", "item"))
    pieces = answers.keep(items.where(~T.is_blank(F.col("item"))).select(*keys, "b", "i", F.posexplode(by_size("most", sizes, lambda most: T.chunks(F.col("item"), most))).alias("c", "text")))
    one = pieces.join(answers.ask(pieces, translator, **policy), "text")
    by_item = one.groupBy(*keys, "b", "i").agg(
        F.array_join(in_order("c", F.coalesce("translation", "text").alias("x")), "").alias("said"),
        F.concat_ws("; ", F.array_sort(F.collect_list(noted()))).alias("error"), F.sum("attempts").alias("tries"),
    )
    found = items.join(by_item, [*keys, "b", "i"], "left")
    by_batch = found.groupBy(*keys, "b").agg(in_order("i", F.coalesce("said", "item").alias("x")).alias("singly"), F.concat_ws("; ", F.array_sort(F.collect_list(F.when(F.col("error") != "", F.col("error"))))).alias("failed"), F.coalesce(F.sum("tries"), F.lit(0)).alias("more"))
    joined = whole.join(by_batch, [*keys, "b"], "left")
    error = F.when(F.col("whole").isNull() & (F.col("failed") != ""), F.concat_ws("; ", F.when(F.col("refused") != "", F.col("refused")), "failed"))
    each = joined.select(*keys, "b", F.coalesce("whole", "singly").alias("x"), error.alias("error"), (F.coalesce("tries", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("tries"))
    return each.groupBy(*keys).agg(F.flatten(in_order("b", "x")).alias("done"), F.concat_ws("; ", in_order("b", F.col("error").alias("x"))).alias("error"), F.sum("tries").alias("attempts"))


def retried(lists: DataFrame, done: DataFrame, translator: str, sizes: list[int], answers: AnswerLog, keys: tuple[str, ...], **policy) -> DataFrame:
    """Items that came back as they were, sent once more where `letters` is not null; those that are still the same are errors."""
    both = lists.join(done, list(keys)).select(*keys, "most", "letters", "error", "attempts", F.posexplode(F.arrays_zip(F.col("items").alias("s"), F.col("done").alias("t"))).alias("i", "p"))
    both = both.select(*keys, "most", "letters", "error", "attempts", "i", "p.s", "p.t")
    same = lambda t: F.coalesce(suspicious_unchanged(F.col("s"), F.col(t), F.col("letters")), F.lit(False))
    pieces = answers.keep(both.where(same("t")).select(*keys, "i", F.posexplode(by_size("most", sizes, lambda most: T.chunks(F.col("s"), most))).alias("c", "text")))
    again = pieces.join(answers.ask(pieces, translator, again=True, **policy), "text").groupBy(*keys, "i").agg(
        F.array_join(in_order("c", F.coalesce("translation", "text").alias("x")), "").alias("second"),
        F.max(F.when(F.col("status") == "error", 1).otherwise(0)).alias("failed"), F.sum("attempts").alias("tries"),
    )
    joined = both.join(again, [*keys, "i"], "left")
    better = F.col("second").isNotNull() & (F.col("failed") == 0) & ~same("second")
    note = F.when(F.col("second").isNotNull() & ~better, F.concat(F.lit("item "), F.col("i").cast("string"), F.lit(": unchanged translation")))
    lined = joined.groupBy(*keys).agg(
        in_order("i", F.when(better, F.col("second")).otherwise(F.col("t")).alias("x")).alias("done"),
        F.first("error").alias("before"), F.concat_ws("; ", F.array_sort(F.collect_list(note))).alias("notes"), (F.first("attempts") + F.coalesce(F.sum("tries"), F.lit(0))).alias("attempts"),
    )
    return lined.select(*keys, "done", F.concat_ws("; ", F.when(F.col("before") != "", F.col("before")), F.when(F.col("notes") != "", F.col("notes"))).alias("error"), "attempts")


def broken_value(rule: Rule, kind: DataType) -> Column:
    """What is wrong with a row's value, or null."""
    strategy, value = REGISTRY[rule.strategy], F.col(rule.source)
    return F.when(value.isNotNull(), strategy.broken(value, rule.options)) if strategy.broken else F.lit(None).cast("string")


def request(number: int, rule: Rule, kind: DataType) -> Column:
    """The texts that a rule asks for of a row, with how to ask; null if it has none."""
    strategy, value, options = REGISTRY[rule.strategy], F.col(rule.source), rule.options
    items = strategy.texts(kind, value, options)
    guards = F.coalesce(passes_guards(F.array_join(items, " "), options.get("guards", options.get("skip_if"))), F.lit(True))
    letters = int(options.get("unchanged_min_letters", 12)) if strategy.retries and options.get("retry_unchanged") else None
    asked = F.struct(F.lit(number).alias("rule"), items.alias("items"), F.lit(int(options.get("max_chunk_chars", MAX_CHARS))).alias("most"), F.lit(letters).cast("int").alias("letters"))
    return F.when(value.isNotNull() & broken_value(rule, kind).isNull() & guards & (F.size(items) > 0), asked)


def translated_texts(rows: DataFrame, rules: list[tuple[int, Rule]], translator: str, answers: AnswerLog, keys: tuple[str, ...], **policy) -> DataFrame:
    """keys, told: for each row that asks for anything a map from the number of a rule to (done, error, attempts). One stage for all rules that send lists, one for all others."""
    def lists_of(rules: list[tuple[int, Rule]]) -> DataFrame:
        asked = F.array_compact(F.array(*(request(i, rule, rows.schema[rule.source].dataType) for i, rule in rules)))
        return rows.select(*keys, F.explode(asked).alias("q")).select(*keys, "q.*")

    of_rule, sizes = (*keys, "rule"), sorted({int(rule.options.get("max_chunk_chars", MAX_CHARS)) for _, rule in rules})
    listed, single = ([(i, rule) for i, rule in rules if REGISTRY[rule.strategy].as_list == x] for x in (True, False))
    again = any(REGISTRY[rule.strategy].retries and rule.options.get("retry_unchanged") for _, rule in rules)
    parts = [translated_lists(lists_of(listed), translator, sizes, answers, of_rule, **policy)] if listed else []
    parts += [translated_items(lists_of(single), translator, sizes, answers, of_rule, keys, **policy)] if single else []
    done = parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]
    if again:
        done = retried(lists_of(rules), done, translator, sizes, answers, of_rule, **policy)
    told = done.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rule", F.struct("done", "error", "attempts")))).alias("_told"))
    # what items are put together from is written already
    return answers.keep(told) if listed or again else told


def translated_logs(rows: DataFrame, rule: Rule, translator: str, answers: AnswerLog, keys: tuple[str, ...], **policy) -> DataFrame:
    """keys, _log: (translation, error) of each browsing log."""
    options, languages = rule.options, (policy.pop("source", "en"), policy.pop("target", "fr"))
    logs = rows.select(*keys, F.col(rule.source).cast("string").alias("query"))
    marks = {"utterances": bool(options.get("translate_agent_utterances", False)), "user": options.get("user_prefix", "User: "), "agent": options.get("agent_prefix", "Agent: ")}
    done = action_logs(logs, "query", translator, languages, keys, answers=answers, **marks, **policy)
    return done.select(*keys, F.struct("translation", "error").alias("_log"))


def translated(rows: DataFrame, rules: list[Rule], translator: str, keys: tuple[str, ...] = ("split", "row_idx"), limit: int = 0, drop: tuple[str, ...] = (), answers: AnswerLog | None = None, **policy) -> DataFrame:
    """Rows (of each split the first `limit`, if given) with the targets of all rules, without dropped columns, and with status, error and attempts.

    Every rule reads the row as it came, whatever others put into it. A rule that cannot apply to its column is an error before any row is
    read; a row that fails keeps its source values. All requests are sent and their answers written before this returns; the
    result itself is lazy, and reading it any number of times sends nothing.
    """
    if found := problems(rows, rules):
        raise ValueError("; ".join(found))
    answers = answers or AnswerLog(rows.sparkSession)
    rows = rows.where(F.col(keys[-1]) < limit) if limit > 0 else rows
    plain = [(i, rule) for i, rule in enumerate(rules) if rule.strategy != "weblinx_query"]
    # a value that is made of its translations goes along only where nothing is asked for it
    unasked = {f"_unasked{i}": F.when(request(i, rule, rows.schema[rule.source].dataType).isNull(), F.col(rule.source)) for i, rule in plain if REGISTRY[rule.strategy].of_texts}
    out = rows.withColumns(unasked).join(translated_texts(rows, plain, translator, answers, keys, **policy), list(keys), "left") if plain else rows.withColumn("_told", F.lit(None))
    targets, errors, attempts = {}, [], F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        value, kind = F.col(rule.source), rows.schema[rule.source].dataType
        if rule.strategy == "weblinx_query":
            out = out.join(translated_logs(rows, rule, translator, answers, keys, **policy).withColumnRenamed("_log", f"_log{i}"), list(keys), "left")
            targets[rule.target], error = F.col(f"_log{i}.translation"), F.col(f"_log{i}.error")
        else:
            told = F.try_element_at("_told", F.lit(i))
            as_it_was = F.col(f"_unasked{i}") if f"_unasked{i}" in unasked else value
            targets[rule.target] = F.when(told["done"].isNull(), as_it_was).otherwise(REGISTRY[rule.strategy].value(kind, value, rule.options, told["done"]))
            error = F.concat_ws("; ", broken_value(rule, kind), F.when(told["error"] != "", told["error"]))
            attempts = attempts + F.coalesce(told["attempts"], F.lit(0))
        errors.append(F.when(error != "", error))
    notes = F.array_compact(F.array(*errors))
    marks = {"status": F.when(F.size(notes) > 0, "error").otherwise("ok"), "error": F.array_join(notes, "; "), "attempts": attempts}
    dropped = [c for c in drop if c not in targets]
    in_place = [targets[c].alias(c) if c in targets else F.col(c) for c in rows.columns if c not in marks and c not in dropped]
    added = [x.alias(c) for c, x in targets.items() if c not in rows.columns]
    return out.select(*in_place, *added, *(x.alias(c) for c, x in marks.items()))
