"""Translation: texts are collected as distinct values, translated once, and put back by expressions or joins."""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .answers import AnswerLog
from .calls import replies, shared_limit, spread
from .runs import RetryPolicy

#: (text, source language, target language) -> translation. A name stands for a way to reach a service.
TRANSLATORS: dict[str, Callable[[str, str, str], str]] = {}


#: How to ask the same service past its memory, where that differs.
AGAIN: dict[str, Callable[[str, str, str], str]] = {}


def register_translator(name: str, f: Callable[[str, str, str], str], again: Callable[[str, str, str], str] | None = None) -> None:
    TRANSLATORS[name] = f
    if again:
        AGAIN[name] = again


#: A translator for tests that leaves markers alone: letters for letters.
register_translator("letters", lambda text, source, target: text.replace("e", "3").replace("a", "4"))
register_translator("prefix", lambda text, source, target: f"{target}:{text}")


# What services take at once, in characters or bytes.
LIMITS = {"google": ("chars", 5_000), "deepl": ("bytes", 120_000), "yandex": ("chars", 10_000)}


def within_limit(provider: str, call: Callable[[str, str, str], str]) -> Callable[[str, str, str], str]:
    """A call of a service that refuses what the service would refuse."""
    unit, most = LIMITS[provider]

    def limited(text: str, source: str, target: str) -> str:
        n = len(text) if unit == "chars" else len(text.encode("utf-8"))
        if n > most:
            raise ValueError(f"{provider} takes at most {most} {unit}, got {n}")
        return call(text, source, target)

    return limited


def passes_guards(c: Column, guards: list[dict] | None) -> Column:
    """Whether a text is to be translated: it has a letter, and matches no pattern, where the guards ask for that. What is no mapping is no guard."""
    if guards is not None and not isinstance(guards, (list, tuple)):
        raise ValueError("guards are a list")
    keep = F.lit(True)
    for guard in guards or ():
        if not isinstance(guard, dict):
            continue
        kind = guard.get("kind")
        if kind == "no_letters":
            keep &= c.rlike(r"\p{L}")
        elif kind == "fullmatch_regex":
            keep &= ~c.rlike(rf"\A(?:{guard['pattern']})\z")
        else:
            raise ValueError(f"unknown guard {kind!r}")
    return keep


def translate_distinct(texts: DataFrame, translator: str, source: str = "en", target: str = "fr", retries: int = 2, column: str = "text", again: bool = False, sleep: float = 0.0, per_minute: int = 0, concurrency: int = 0, parts: int = 0) -> DataFrame:
    """Every distinct text once (again: of a service that remembers its answers, a new one): text, translation (null if it failed), status, attempts, error. A failure is a row, not the end of the job.

    The calls are in the plan: whoever reads the result twice calls twice (see AnswerLog). sleep: of the first wait before
    another attempt; per_minute, concurrency: calls in 60 seconds and at once, of all tasks together; parts: tasks to deal
    the texts to.
    """
    call = AGAIN.get(translator, TRANSLATORS[translator]) if again else TRANSLATORS[translator]
    policy, limit = RetryPolicy(retries, sleep), shared_limit(texts.sparkSession, per_minute, concurrency)

    def run(batches):
        for batch in batches:
            values = batch.column(0).to_pylist()
            out = [(v, r.value, "ok" if r.value is not None else "error", r.attempts, r.error) for v, r in zip(values, replies(values, lambda v: call(v, source, target), policy, limit), strict=True)]
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.string(), pa.int32(), pa.string()), strict=True)], names=["text", "translation", "status", "attempts", "error"])

    wanted = texts.select(F.col(column).alias("text")).where("text is not null")
    least = spread(texts.sparkSession, limit)
    # dealt by text, they are moved once; few texts that may be asked for at once are dealt evenly
    distinct = wanted.repartition(parts, "text").distinct() if parts > least else wanted.distinct().repartition(least) if least else wanted.distinct()
    return distinct.mapInArrow(run, "text string, translation string, status string, attempts int, error string")


def translate_column(rows: DataFrame, source: str, target: str, translator: str, max_chars: int = 2500, guards: list[dict] | None = None, keys: tuple[str, ...] = ("split", "row_idx"), unchanged_is_error: bool = False, answers: AnswerLog | None = None, **languages) -> DataFrame:
    """The rows with a translated text column, its status and error. Requests are sent, once, before this returns.

    Long texts go in chunks, which come back in order; a failed chunk keeps its source. An English text that came back
    the same is an error where that is asked for, so a resumed run sends it again.
    """
    wanted = ~T.is_blank(F.coalesce(F.col(source), F.lit(""))) & passes_guards(F.col(source), guards)
    answers = answers or AnswerLog(rows.sparkSession)
    pieces = answers.keep(rows.where(wanted).select(*keys, F.posexplode(T.chunks(F.col(source), max_chars)).alias("i", "text")))
    done = pieces.join(answers.ask(pieces, translator, **languages), "text")
    whole = done.groupBy(*keys).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", F.coalesce("translation", "text").alias("x")))), lambda p: p["x"]), "").alias(target),
        F.max(F.when(F.col("status") == "error", F.col("error"))).alias("error"),
    )
    if unchanged_is_error:
        same = rows.select(*keys, F.col(source).alias("_source")).join(whole, list(keys))
        whole = same.withColumn("error", F.coalesce("error", F.when(suspicious_unchanged(F.col("_source"), F.col(target)), "unchanged translation"))).drop("_source")
    out = rows.drop(*([target] if target != source else [])).join(whole.withColumnRenamed(target, "_done"), list(keys), "left")
    return out.withColumns({target: F.coalesce("_done", source), "status": F.when(F.col("error").isNotNull(), "error").otherwise("ok"), "error": F.coalesce("error", F.lit(""))}).drop("_done")


def translate_lists(rows: DataFrame, source: str, target: str, translator: str, keys: tuple[str, ...] = ("split", "row_idx"), **languages) -> DataFrame:
    """The rows with every item of a list translated; blank items stay, and the list keeps its length."""
    items = rows.select(*keys, F.posexplode(source).alias("i", "text"))
    done = items.join(AnswerLog(rows.sparkSession).ask(items.where(~T.is_blank(F.col("text"))), translator, **languages), "text", "left")
    lists = done.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", F.coalesce("translation", "text", F.lit("")).alias("x")))), lambda p: p["x"]).alias("_done"))
    return rows.join(lists, list(keys), "left").withColumn(target, F.coalesce("_done", source)).drop("_done")


def suspicious_unchanged(source: Column, translation: Column, min_letters: int = 12) -> Column:
    """Whether to translate again: an English text of so many letters that came back the same."""
    return (T.letter_count(source) >= min_letters) & T.has_english_signal(source) & (T.norm_text(source) == T.norm_text(translation))


RECORD_START = re.compile(r"[a-z_]+\(")


def action_records(query: str, user: str = "User: ", agent: str = "Agent: ") -> list[str]:
    """A browsing log as records, each beginning with a speaker or a call."""
    out: list[list[str]] = []
    for line in query.splitlines():
        if not out or line.startswith((user, agent)) or RECORD_START.match(line):
            out.append([])
        out[-1].append(line)
    return ["\n".join(lines) for lines in out]


#: A quoted value: doubled quotes around it, or single ones of either kind, with backslash escapes left as they are.
QUOTED = re.compile(r'""((?:[^"\\]|\\.|"(?!"))*)""|"((?:[^"\\]|\\.)*)"|\'((?:[^\'\\]|\\.)*)\'', re.S)


def quoted_value(text: str, start: int = 0) -> tuple[str, int] | None:
    """The quoted value that begins at start, and where what follows it begins."""
    found = QUOTED.match(text, start)
    return (next(g for g in found.groups() if g is not None), found.end()) if found else None


def with_utterance(record: str, call, languages: tuple[str, str], agent: str = "Agent: ") -> str:
    """An agent's say() with its utterance translated; any other record as it is."""
    at = record.find("utterance=")
    if not record.startswith(f"{agent}say(") or at < 0:
        return record
    at += len("utterance=")
    found = quoted_value(record, at)
    if found is None or not found[0].strip():
        return record
    marks = (found[1] - at - len(found[0])) // 2
    return record[: at + marks] + call(found[0], *languages) + record[found[1] - marks :]


def blocks_of_lines(text: str) -> list[tuple[str, bool]]:
    """A text as runs of lines that are blank or not, with whether a run is not."""
    out: list[tuple[list[str], bool]] = []
    for line in text.split("\n"):
        said = bool(line.strip())
        if out and out[-1][1] == said:
            out[-1][0].append(line)
        else:
            out.append(([line], said))
    return [("\n".join(lines), said) for lines, said in out]


def said_in(query: str, send: Callable[[str, int], str], utterances: bool, user: str, agent: str) -> str:
    """A browsing log with what is said replaced by what `send` (text, number of its record) makes of it. Lines between blank ones go together, and blank ones stay."""
    out = []
    for i, record in enumerate(action_records(query, user, agent)):
        if record.startswith(user):
            said = record[len(user) :]
            letters = re.search(r"[^\W\d_]", said)
            out.append(user + ("\n".join(send(x, i) if keep else x for x, keep in blocks_of_lines(said)) if letters else said))
        elif utterances:
            out.append(with_utterance(record, lambda text, *_, i=i: send(text, i), ("", ""), agent))
        else:
            out.append(record)
    return "\n".join(out)


def action_logs(rows: DataFrame, column: str, translator: str, languages: tuple[str, str] = ("en", "fr"), keys: tuple[str, ...] = ("split", "row_idx"), utterances: bool = False, user: str = "User: ", agent: str = "Agent: ", answers: AnswerLog | None = None, **policy) -> DataFrame:
    """Browsing logs with what the user says translated, and the agent's utterances if asked for.

    The texts of all logs are collected and asked for once, as those of every strategy; then each log is put together again. A failed
    call keeps its text and is the row's error, as are changed numbers of lines and changed actions.
    """
    policy = {"retries": 0} | policy

    def texts_of(batches):
        for batch in batches:
            found: list[list[str]] = []
            for query in batch.column(column).to_pylist():
                texts: list[str] = []
                said_in(query or "", lambda text, i, texts=texts: texts.append(text) or text, utterances, user, agent)
                found.append(texts)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(found, pa.list_(pa.string()))], names=[*keys, "texts"])

    def put_back(batches):
        for batch in batches:
            out = []
            for query, told in zip(batch.column(column).to_pylist(), batch.column("told").to_pylist(), strict=True):
                known, errors = {t["text"]: (t["translation"], t["error"]) for t in told or ()}, []

                def send(text: str, number: int, known=known, errors=errors) -> str:
                    translation, error = known.get(text, (None, "no answer"))
                    if translation is None:
                        errors.append(f"line {number}: {error}")
                    return text if translation is None else translation

                out.append((None if query is None else said_in(query, send, utterances, user, agent), "; ".join(errors)))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), batch.column(column), pa.array([x for x, _ in out], pa.string()), pa.array([e for _, e in out], pa.string())], names=[*keys, column, "translation", "_failed"])

    kinds = dict(rows.dtypes)
    of_keys = ", ".join(f"{k} {kinds[k]}" for k in keys)
    logs = rows.select(*keys, column)
    answers = answers or AnswerLog(rows.sparkSession)
    texts = answers.keep(logs.mapInArrow(texts_of, f"{of_keys}, texts array<string>").select(*keys, F.explode(F.array_distinct("texts")).alias("text")))
    found = texts.join(answers.ask(texts, translator, *languages, **policy), "text")
    told = found.groupBy(*keys).agg(F.collect_list(F.struct("text", "translation", "error")).alias("told"))
    done = logs.join(told, list(keys), "left").mapInArrow(put_back, f"{of_keys}, {column} {kinds[column]}, translation string, _failed string")
    lines = lambda c: F.size(F.split(c, "\n"))
    changed = F.when(lines(F.col(column)) != lines(F.col("translation")), "line count changed").when(T.action_sequence(F.col(column)) != T.action_sequence(F.col("translation")), "actions changed")
    return done.withColumn("error", F.concat_ws("; ", F.when(F.col("_failed") != "", F.col("_failed")), changed)).drop("_failed")
