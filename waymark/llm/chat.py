"""Chat formatting: a schema fingerprint picks the mapping that turns a record into canonical turns.

A record is one JSON text. Its fingerprint hashes its nested field paths (names
and arrays, no types), so records written by one tool share it whatever their
values. ``MAPPINGS`` declares, for each known layout, where the turns are.

The template opens a turn with ``<|im_start|>role`` and a line feed and closes
it with ``<|im_end|>`` and a line feed. Inside texts and roles a backslash is
put after the first character of every control string; where backslashes stand
there already, one is added, so reading back takes exactly one away.

Everything here is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: Strings that must not show up in formatted text but as marks; each begins with < or [ and holds neither again.
CONTROLS = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|system|>", "<|user|>", "<|assistant|>", "<|endoftext|>")
_TAILS = r"(\|im_start\|>|\|im_end\|>|/?s>|/?INST\]|/?SYS>>|\|system\|>|\|user\|>|\|assistant\|>|\|endoftext\|>)"
ESCAPE = r"([<\[])(\\*)" + _TAILS
UNESCAPE = r"([<\[])(\\*)\\" + _TAILS

TURNS = "array<struct<role:string,text:string>>"


def _pairs(**fields: str) -> str:
    """SQL for turns of fixed roles; a turn whose field is missing or null is left out, one with an empty text stays."""
    turns = ", ".join(f"named_struct('role', '{role}', 'text', get_json_object(record, '$.{path}'))" for role, path in fields.items())
    return f"filter(array({turns}), t -> t.text is not null)"


def _listed(path: str, role: str, text: str) -> str:
    kind = f"array<struct<`{role}`:string,`{text}`:string>>"
    return f"transform(from_json(get_json_object(record, '$.{path}'), '{kind}'), t -> named_struct('role', coalesce(t.`{role}`, ''), 'text', coalesce(t.`{text}`, '')))"


#: Field paths of a layout, as ``field_paths`` writes them, and the SQL expression over ``record`` that gives its turns.
MAPPINGS = {
    "{messages:[{content,role}]}": _listed("messages", "role", "content"),
    "{conversations:[{from,value}]}": _listed("conversations", "from", "value"),
    "{prompt,response}": _pairs(user="prompt", assistant="response"),
    "{completion,prompt}": _pairs(user="prompt", assistant="completion"),
    "{instruction,output}": _pairs(user="instruction", assistant="output"),
    "{instruction,output,system}": _pairs(system="system", user="instruction", assistant="output"),
    "{input,instruction,output}": (
        "array(named_struct('role', 'user', 'text', concat_ws('\\n\\n', get_json_object(record, '$.instruction'), nullif(get_json_object(record, '$.input'), ''))), "
        "named_struct('role', 'assistant', 'text', coalesce(get_json_object(record, '$.output'), '')))"
    ),
}


def field_paths(record: Column) -> Column:
    """The nested field names of a JSON text without types: ``{messages:[{content,role}]}``; null for text that is no JSON."""
    kind = F.schema_of_variant(F.try_parse_json(record))
    shape = F.regexp_replace(kind, r"OBJECT<", "{")
    shape = F.regexp_replace(shape, r"ARRAY<", "[")
    # Scalars go; what closes is told apart by what it opened.
    shape = F.regexp_replace(shape, r": (?![\[{])[A-Z]+(\(\d+,\s?\d+\))?", "")
    shape = F.regexp_replace(shape, r"\[(?![\[{])[A-Z]+(\(\d+,\s?\d+\))?>", "[>")
    shape = F.regexp_replace(F.regexp_replace(shape, ": ", ":"), ", ", ",")
    for _ in range(4):  # this closes the innermost brackets first, four levels deep
        shape = F.regexp_replace(F.regexp_replace(shape, r"\{([^<>\[{]*)>", "{$1}"), r"\[([^<>\[]*)>", "[$1]")
    # Spark's variants end at some megabytes; of longer records the first message stands for all.
    keys = lambda text: F.concat(F.lit("{"), F.array_join(F.sort_array(F.json_object_keys(text)), ","), F.lit("}"))
    listed = [F.concat(F.lit("{" + name + ":["), keys(F.get_json_object(record, f"$.{name}[0]")), F.lit("]}")) for name in ("messages", "conversations")]
    return F.coalesce(shape, *listed, keys(record))


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(paths)


def canonical_turns(records: DataFrame) -> DataFrame:
    """Adds ``fingerprint`` and ``turns`` to records (key, record).

    An unknown layout, text that is no JSON and a null record get null turns, to
    be looked at and given a mapping. An empty list of messages gives no turns.
    """
    known = F.lit(None).cast(TURNS)
    for paths, turns in MAPPINGS.items():
        known = F.when(F.col("fingerprint") == fingerprint(F.lit(paths)), F.expr(turns)).otherwise(known)
    out = records.withColumn("fingerprint", fingerprint(field_paths(F.col("record"))))
    # An empty list has no fields below it.
    empty = F.get_json_object("record", "$.messages").eqNullSafe("[]") | F.get_json_object("record", "$.conversations").eqNullSafe("[]")
    return out.withColumn("turns", F.when(empty, F.array().cast(TURNS)).otherwise(known))


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1$2\\$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, r"$1$2$3")


def _role_out(role: Column) -> Column:
    return F.replace(F.replace(escaped(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def _role_in(role: Column) -> Column:
    lines = F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return unescaped(F.replace(lines, F.lit("\\\\"), F.lit("\\")))


def formatted(canonical: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Adds ``formatted`` and ``loss_spans`` to rows with ``turns``: the text, and start and length, in code points, of what the loss counts.

    The loss counts the texts of ``trained_role``, without marks. Null turns give nulls.
    """
    parts = F.transform("turns", lambda t: F.struct(
        t["role"].alias("role"), F.concat(F.lit(OPEN), _role_out(t["role"]), F.lit("\n")).alias("head"), escaped(t["text"]).alias("body")))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.char_length(p["head"])
        size = F.char_length(p["body"]).cast("long")
        span = F.array(F.struct(start.cast("long").alias("start"), size.alias("length")))
        return F.struct((start + size + len(CLOSE)).cast("long").alias("at"), F.when(p["role"] == trained_role, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return (
        canonical.withColumn("_parts", parts)
        .withColumn("formatted", F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), ""))
        .withColumn("loss_spans", F.aggregate("_parts", zero, step)["spans"])
        .drop("_parts")
    )


def read_back(formatted_text: Column) -> Column:
    """The turns of a formatted text."""
    # The last mark closes the last turn, so what follows it is no turn.
    raw = F.split(formatted_text, r"<\|im_end\|>\n")
    turn = lambda t: F.struct(
        _role_in(F.substring_index(F.substring(t, len(OPEN) + 1, 1 << 30), "\n", 1)).alias("role"),
        unescaped(t.substr(F.instr(t, "\n") + 1, F.char_length(t))).alias("text"))
    return F.transform(F.slice(raw, 1, F.size(raw) - 1), turn)


def loss_text(formatted_text: Column, spans: Column) -> Column:
    """All text the loss counts, unescaped, in order, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescaped(formatted_text.substr((s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def records_of(rows: DataFrame) -> DataFrame:
    """Conversation rows (conv_id, turn, role, text) as one JSON record each, in the layout its roles fit.

    Turns are ordered by turn, then role, then text; repeated rows stay. Null
    roles and texts are empty. Rows with a null conv_id are one conversation,
    null turns come first. A conversation is one value, so it must fit one row.
    """
    turns = F.sort_array(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))))
    roles = F.transform("turns", lambda t: t["role"])
    text = lambda i: F.col("turns")[i]["text"]
    listed = lambda role, content: F.transform("turns", lambda t: F.struct(t["role"].alias(role), t["text"].alias(content)))
    fits = lambda *names: roles == F.array(*(F.lit(n) for n in names))
    record = (
        F.when(fits("user", "assistant"), F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response"))))
        .when(fits("system", "user", "assistant"), F.to_json(F.struct(text(0).alias("system"), text(1).alias("instruction"), text(2).alias("output"))))
        .when(F.element_at(roles, 1) == "system", F.to_json(F.struct(listed("from", "value").alias("conversations"))))
        .otherwise(F.to_json(F.struct(listed("role", "content").alias("messages"))))
    )
    return rows.select("conv_id", "turn", "role", "text").groupBy("conv_id").agg(turns.alias("turns")).select("conv_id", record.alias("record"))
