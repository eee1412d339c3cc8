"""Chat formatting in budgeted windows, with DataFrame functions alone.

A conversation becomes one or more windows of at most ``budget`` tokens. A running sum
of turn tokens closes a window before the turn that would not fit; every later window
starts with the conversation's leading system turn and repeats the last turns of the
window before, as far as ``history_turns`` and ``history_tokens`` allow. Repeated turns
are context: the loss mask covers each assistant text in the one window where it is new.
A turn that alone exceeds the budget gets a window of its own, marked ``over_budget``.

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside
texts get a backslash after their first character, and those that have backslashes
there already get one more, so the escape can be undone and no text ends a turn.

* A null text or role is empty. Turns are ordered by ``turn`` (null first), ties by role
  and text, so equal rows stay as many as they are.
* Rows without ``conv_id`` cannot be told together; each is a conversation by itself.
* An empty table gives no window. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that chat templates give a meaning, without their first character.
_CONTROL = r"/?s>|/?INST\]|</?SYS>>|\|(?:im_start|im_end|im_sep|endoftext|startoftext|system|user|assistant|end)\|>"
_ESCAPE, _UNESCAPE = rf"([<\[])(\\*)({_CONTROL})", rf"([<\[])(\\*)\\({_CONTROL})"

BUDGET, HISTORY_TURNS, HISTORY_TOKENS = 512, 2, 128
#: Tokens of the marks around a turn.
_FRAME_TOKENS = 6


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2$3")


#: In a role, which ends at a line break, these are written in two characters.
_IN_ROLE = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"))


def _escape_role(role: Column) -> Column:
    for plain, written in _IN_ROLE:
        role = F.replace(role, F.lit(plain), F.lit(written))
    return escape(role)


def _unescape_role(role: Column) -> Column:
    role = unescape(role)
    # No carriage return is left, so it can set the pairs apart until all are found.
    for n, (_, written) in enumerate(_IN_ROLE):
        role = F.replace(role, F.lit(written), F.lit(f"\r{n}"))
    for n, (plain, _) in enumerate(_IN_ROLE):
        role = F.replace(role, F.lit(f"\r{n}"), F.lit(plain))
    return role


def token_estimate(text: Column) -> Column:
    """Words and marks, counted as runs of letters, digits or others; an estimate that needs no tokenizer."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{M}]{1,6}|\p{N}{1,3}|[^\s\p{L}\p{M}\p{N}]+"))


def windows(
    turns: DataFrame, budget: int = BUDGET, history_turns: int = HISTORY_TURNS, history_tokens: int = HISTORY_TOKENS
) -> DataFrame:
    """Windows of ``turns`` (conv_id, turn, role, text).

    Columns: conv_id, part (no null, one for each conversation or row without id), window
    (from 0), text, n_tokens, n_turns, n_context (leading turns that are repeated), loss
    (array of (start, length) in code points of ``text``), over_budget.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    own = turns.select(
        "conv_id",
        F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).otherwise(-1).alias("part"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        (token_estimate(text) + token_estimate(role) + _FRAME_TOKENS).cast("long").alias("tokens"),
    )
    # A conversation is one value of the result's digests anyway; its turns meet once, in one shuffle.
    talks = own.groupBy("conv_id", "part").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "tokens"))).alias("turns")
    )
    talks = talks.withColumn("lead", F.expr("if(turns[0].role = 'system', 1, 0)"))
    # The greedy cut is a fold over the turns' tokens; ``spans`` holds the first new turn of each window,
    # ``used`` the tokens of the open window including system turn and history.
    history = f"""
        aggregate(slice(sequence(1, {history_turns}), 1, greatest(i - lead, 0)), named_struct('n', 0, 'sum', 0L, 'open', true),
            (h, k) -> if(h.open and i - k >= lead and k <= i - element_at(acc.spans, -1)
                           and h.sum + turns[i - k].tokens <= least({history_tokens}L, {budget}L - system - turns[i].tokens),
                named_struct('n', k, 'sum', h.sum + turns[i - k].tokens, 'open', true),
                named_struct('n', h.n, 'sum', h.sum, 'open', false)))"""
    fold = f"""
        aggregate(sequence(1, size(turns) - 1),
            named_struct('spans', array(0), 'context', array(0), 'used', turns[0].tokens),
            (acc, i) -> if(acc.used + turns[i].tokens <= {budget},
                named_struct('spans', acc.spans, 'context', acc.context, 'used', acc.used + turns[i].tokens),
                named_struct('spans', concat(acc.spans, array(i)),
                             'context', concat(acc.context, array({history}.n)),
                             'used', system + {history}.sum + turns[i].tokens)))"""
    talks = talks.withColumn("system", F.expr("if(lead = 1, turns[0].tokens, 0L)")).withColumn(
        "cut",
        F.expr(f"if(size(turns) = 1, named_struct('spans', array(0), 'context', array(0), 'used', turns[0].tokens), {fold})"),
    )
    cut = talks.select(
        "conv_id", "part", "turns", "lead", F.col("cut.spans").alias("spans"), F.col("cut.context").alias("context"),
        F.posexplode("cut.spans").alias("window", "first"),
    )
    head = "if(window > 0, slice(turns, 1, lead), slice(turns, 1, 0))"
    past = "slice(turns, first + 1 - context[window], context[window])"
    new = "slice(turns, first + 1, coalesce(get(spans, window + 1), size(turns)) - first)"
    cut = cut.select(
        "conv_id", "part", "window",
        F.expr(f"concat({head}, {past})").alias("context"),
        F.expr(new).alias("new"),
    ).withColumn("all", F.concat("context", "new"))

    def header(t: Column) -> Column:
        return F.concat(F.lit(START), _escape_role(t["role"]), F.lit("\n"))

    def formatted(t: Column) -> Column:
        return F.concat(header(t), escape(t["text"]), F.lit(END + "\n"))

    cut = cut.withColumn("marked", F.transform("all", formatted))
    # (position in the text, spans so far): each new assistant text is a span.
    spans = F.aggregate(
        F.transform(
            "all",
            lambda t, i: F.struct(
                F.length(header(t)).cast("long").alias("head"),
                F.length(escape(t["text"])).cast("long").alias("body"),
                ((t["role"] == "assistant") & (i >= F.size("context"))).alias("target"),
            ),
        ),
        F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start: bigint, length: bigint>>)").alias("loss")),
        lambda acc, t: F.struct(
            (acc["at"] + t["head"] + t["body"] + len(END) + 1).alias("at"),
            F.when(
                t["target"],
                F.concat(acc["loss"], F.array(F.struct((acc["at"] + t["head"]).alias("start"), t["body"].alias("length")))),
            ).otherwise(acc["loss"]).alias("loss"),
        ),
        lambda acc: acc["loss"],
    )
    tokens = F.aggregate("all", F.lit(0).cast("long"), lambda acc, t: acc + t["tokens"])
    return cut.select(
        "conv_id", "part", "window",
        F.array_join("marked", "").alias("text"),
        tokens.alias("n_tokens"),
        F.size("all").alias("n_turns"),
        F.size("context").alias("n_context"),
        spans.alias("loss"),
        (tokens > budget).alias("over_budget"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, part, turns: array of (role, text) in order, targets: the texts under the loss mask, formatted_chars)."""
    parsed = F.transform(
        F.slice(F.split("text", "<[|]im_start[|]>", -1), F.lit(2), F.col("n_turns")),
        lambda turn: F.struct(
            _unescape_role(F.substring_index(turn, "\n", 1)).alias("role"),
            unescape(
                turn.substr(F.length(F.substring_index(turn, "\n", 1)) + 2,
                            F.length(turn) - F.length(F.substring_index(turn, "\n", 1)) - (2 + len(END)))
            ).alias("text"),
        ),
    )
    targets = F.transform("loss", lambda s: unescape(F.col("text").substr((s["start"] + 1).cast("int"), s["length"].cast("int"))))
    one = formatted.select(
        "conv_id", "part", "window", "n_context", "n_turns",
        parsed.alias("turns"), targets.alias("targets"), F.length("text").cast("long").alias("chars"),
    ).withColumn("turns", F.expr("slice(turns, n_context + 1, n_turns - n_context)"))
    whole = one.groupBy("conv_id", "part").agg(
        F.sort_array(F.collect_list(F.struct("window", "turns", "targets"))).alias("windows"), F.sum("chars").alias("formatted_chars")
    )
    return whole.select(
        "conv_id", "part",
        F.flatten(F.col("windows.turns")).alias("turns"),
        F.flatten(F.col("windows.targets")).alias("targets"),
        "formatted_chars",
    )
