"""Conversations rebuilt from event logs and rendered with a reversible template."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

TURN, TEXT, LOSS, END = "<|turn|>", "<|text|>", "<|loss|>", "<|end|>"
#: Characters that markers use, and what stands for them in texts.
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")]


def escape(c):
    for raw, out in ESCAPES:
        c = F.replace(c, F.lit(raw), F.lit(out))
    return c


def unescape(c):
    for raw, out in reversed(ESCAPES):
        c = F.replace(c, F.lit(out), F.lit(raw))
    return c


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, turns: array of role and text) from (conv_id, msg, part, seq, op, role, text).

    The events of one part of a message apply by seq, ties by op, role and text:
    `create`, `edit` and `regenerate` set the text, `delta` appends to it and
    `delete` removes the message. A second `create` in one part is a message of its
    own. Without a column part each message is one part; where it has several,
    they are messages of their own, by role and text. Null texts, roles and ops are
    empty, empty and `create`; null ids are an id like others. Messages stand by
    msg. A message is folded before conversations gather, so a long log is not
    one task's work; a conversation itself is one row, whatever its length, as it
    is rendered as one text. Repeated events apply again. An empty log gives no
    rows; other columns are not read.
    """
    part = ["part"] if "part" in events.columns else []
    e = events.select("conv_id", "msg", *part, F.struct("seq", F.coalesce("op", F.lit("create")).alias("op"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("e"))
    logs = e.groupBy("conv_id", "msg", *part).agg(F.sort_array(F.collect_list("e")).alias("log"))
    # each create opens a run of events that ends before the next one
    opens = F.expr("filter(sequence(1, size(log)), i -> i = 1 or log[i - 1].op = 'create')")
    runs = logs.withColumn("opens", opens).withColumn("runs", F.expr("transform(opens, (o, k) -> slice(log, o, coalesce(try_element_at(opens, k + 2), size(log) + 1) - o))"))
    last = "array_max(transform(r, (x, k) -> if(x.op in ('create', 'edit', 'regenerate'), k + 1, 1)))"
    texts = F.expr(f"""transform(filter(runs, r -> r[size(r) - 1].op <> 'delete'),
        r -> struct(r[0].role as role, array_join(transform(slice(r, {last}, size(r)), x -> x.text), '') as text))""")
    done = runs.select("conv_id", F.struct("msg", texts.alias("turns")).alias("m"))
    return done.groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("m")).select("conv_id", F.expr("flatten(transform(m, x -> x.turns))").alias("turns"))


def render(folded: DataFrame) -> DataFrame:
    """(conv_id, formatted): assistant texts open with the loss marker, others with the text marker.

    Marker characters inside roles and texts are escaped, so `read_back` gives
    back what came in: empty texts, markers and very long texts among them. A
    conversation without messages is empty.
    """
    one = F.transform("turns", lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.when(t["role"] == "assistant", LOSS).otherwise(TEXT), escape(t["text"]), F.lit(END)))
    return folded.select("conv_id", F.array_join(one, "").alias("formatted"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns: role, text, loss) parsed from the rendered strings."""
    parts = F.expr(r"filter(split(formatted, '<\\|turn\\|>'), (x, i) -> i > 0)")

    def turn(x):
        bits = F.split(F.replace(x, F.lit(END), F.lit("")), r"<\|(?:text|loss)\|>", 2)
        return F.struct(unescape(bits[0]).alias("role"), unescape(bits[1]).alias("text"), x.contains(LOSS).alias("loss"))

    return formatted.select("conv_id", "formatted", F.transform(parts, turn).alias("turns"))


def digest(parsed: DataFrame) -> DataFrame:
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return parsed.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def log_of(turns: DataFrame) -> DataFrame:
    """An event log that ends in these turns (conv_id, turn, role, text): each is streamed, edited, begun again and streamed anew."""
    n = F.length("text")
    cut = lambda k: (F.substring("text", F.lit(1), k.cast("int")), F.substring("text", k.cast("int") + 1, n))
    (one, two), (three, four) = cut(F.floor(n / 2)), cut(F.floor(n / 3))
    steps = [("create", one), ("delta", two), ("edit", F.concat(F.lit("<draft> "), "text")), ("regenerate", three), ("delta", four)]
    log = F.array(*[F.struct(F.lit(k).alias("seq"), F.lit(op).alias("op"), text.alias("text")) for k, (op, text) in enumerate(steps)])
    rows = turns.select("conv_id", F.col("turn").alias("msg"), F.monotonically_increasing_id().alias("part"), "role", F.coalesce("text", F.lit("")).alias("text"))
    return rows.select("conv_id", "msg", "part", "role", F.explode(log).alias("e")).select("conv_id", "msg", "part", "e.seq", "e.op", "role", "e.text")


def op6_chat(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    more = spark.sql("select -7L conv_id, t.turn, t.role, '</s>[INST] ok [/INST]' text from values (0L, 'user'), (1L, 'assistant') t(turn, role)")
    return digest(read_back(render(fold(log_of(rows.unionByName(more))))))


SQL = {"op6_chat": r"""
with t as (
  select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as x from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (select *, length(replace(replace(replace(r, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'))
  + length(replace(replace(replace(x, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) + 23 as n from t)
select conv_id, count(*) as n_turns,
  sha256(string_agg(r || chr(10) || x || chr(10), '' order by turn nulls first, r, x)) as turns_sha256,
  coalesce(sum(length(x)) filter (r = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(x, '' order by turn nulls first, x) filter (r = 'assistant'), '')) as loss_sha256,
  sum(n)::bigint as formatted_chars
from e group by conv_id"""}
