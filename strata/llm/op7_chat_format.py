"""Chat formatting in budgeted windows [native].

A conversation is cut into windows of whole turns.  Prefix sums of the turns'
token counts (words plus ``TURN_TOKENS`` marks) place every turn: after taking
the system turn and the repeated history from the budget, turn ``i`` belongs to
cell ``floor(prefix_i / cell)`` with cells of half of what is left, so a window
with its last, overhanging turn stays inside the budget; a turn larger than a
cell stands alone.  Every window begins with the system turn (the first turn, if
its role is ``system``), repeats up to ``HISTORY_TURNS`` turns before it as far
as ``HISTORY_TOKENS`` allow, and then brings its new turns.  Loss spans cover the
texts of new assistant turns only: repeated targets are masked.

No window is above the budget unless one turn alone is: beside a turn that
stands alone history takes what it leaves, and without room for the system turn
it has its window to itself (then a system turn that no other turn follows there
has one, too).  Only a turn above the budget makes a larger window, of this turn
and nothing else.  A system turn that leaves less than two cells of ``MIN_CELL``
is an ordinary turn and is not repeated.

Template, one turn: ``<s>role\\n`` + text + ``</s>``.  Control strings inside
texts are escaped reversibly: ``\\`` becomes ``\\0``, and ``<s>``, ``</s>``,
``[INST]``, ``[/INST]`` become ``\\1`` to ``\\4``; in roles ``%``, line feeds and
``<`` are percent-coded.  ``read_back`` recovers the turns from the windows.

Everything is DataFrame functions: a shuffle by conversation, window functions
and one aggregate a window.

Defined cases: null text is empty; a null role is empty; turns order by turn,
role, text, so repeated turn numbers are kept side by side; null ids form one
conversation; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 1024
TURN_TOKENS = 4
HISTORY_TURNS = 2
HISTORY_TOKENS = 256
#: Smallest cell that a system turn must leave (twice) to be repeated.
MIN_CELL = 64

# Control strings of the template and their escapes, in order.
CONTROL = [("\\", "\\0"), ("<s>", "\\1"), ("</s>", "\\2"), ("[INST]", "\\3"), ("[/INST]", "\\4")]
ROLE_CODES = [("%", "%25"), ("\n", "%0A"), ("<", "%3C")]


def _replace(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escape(text: Column, codes: list[tuple[str, str]] = CONTROL) -> Column:
    return _replace(text, codes)


def unescape(text: Column, codes: list[tuple[str, str]] = CONTROL) -> Column:
    return _replace(text, [(new, old) for old, new in reversed(codes)])


def format_windows(turns: DataFrame, budget: int = BUDGET) -> DataFrame:
    """One row a window: conv_id, window (from 0), formatted, n_tokens,
    n_repeated (leading turns that an earlier window brought already), n_new,
    and loss_spans (start from 1 and length, in code points of ``formatted``).
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    placed = (
        rows.withColumn("tokens", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")) + TURN_TOKENS)
        .withColumn("i", F.row_number().over(order) - 1)
        .withColumn("prefix", F.coalesce(F.sum("tokens").over(so_far), F.lit(0)))
        .withColumn("is_system", (F.col("i") == 0) & (F.col("role") == "system")
                    & (F.col("tokens") <= budget - HISTORY_TOKENS - 2 * MIN_CELL))
        .withColumn("system", F.max(F.when(F.col("is_system"), F.struct("tokens", "role", "text"))).over(whole))
        .withColumn("system_tokens", F.coalesce("system.tokens", F.lit(0))))
    cell = F.floor((budget - HISTORY_TOKENS - F.col("system_tokens")) / 2).cast("long")
    at = (F.col("prefix") - F.col("system_tokens")).cast("long")
    left = budget - F.col("system_tokens") - F.col("tokens")
    new_turns = (
        placed.withColumn("cell", cell)
        .withColumn("slot", ((at - at % F.col("cell")) / F.col("cell")).cast("long"))
        .withColumn("alone", ~F.col("is_system") & (F.col("tokens") > F.col("cell")))
        # Tokens for history beside a turn; below zero the system turn has no room either.
        .withColumn("room", F.when(F.col("alone"), F.least(F.lit(HISTORY_TOKENS), left)).otherwise(HISTORY_TOKENS))
        # The turn after one that stands alone opens a window, too.
        .withColumn("opens", F.when(F.col("is_system"), F.coalesce(F.lead("room").over(order) < 0, F.lit(False)))
                    .otherwise(F.coalesce(
                        (F.col("slot") != F.lag("slot").over(order)) | F.col("alone") | F.lag("alone").over(order)
                        | F.lag("is_system").over(order), F.lit(True))))
        .withColumn("window", F.greatest(
            F.sum(F.col("opens").cast("long")).over(
                order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - 1, F.lit(0))))

    # A turn goes to its own window, and as history to the windows that open
    # within the next HISTORY_TURNS turns and near enough in tokens; the turn
    # that opens a window brings the system turn along.
    later = [F.when(~F.col("is_system") & F.coalesce(F.lead("opens", d).over(order), F.lit(False))
                    & (F.lead("prefix", d).over(order) - F.col("prefix") <= F.lead("room", d).over(order)),
                    F.lead("window", d).over(order)) for d in range(1, HISTORY_TURNS + 1)]
    leads = F.col("opens") & ~F.col("is_system") & (F.col("window") > 0) & (F.col("room") >= 0)
    shown = (
        new_turns.withColumn("history", F.array_distinct(F.array_compact(F.array(*later))))
        .withColumn("with_system", F.when(leads & F.col("system").isNotNull(), F.array("window")).otherwise(
            F.array().cast("array<bigint>")))
        .select("conv_id", "i", "role", "text", "tokens", "window", "system", F.explode(F.concat(
            F.array(F.struct(F.col("window").alias("to"), F.lit("own").alias("as"))),
            F.transform("history", lambda w: F.struct(w.alias("to"), F.lit("history").alias("as"))),
            F.transform("with_system", lambda w: F.struct(w.alias("to"), F.lit("system").alias("as"))))).alias("e"))
        .select("conv_id", F.col("e.to").alias("to"), (F.col("e.as") != "own").alias("repeated"),
                *(F.when(F.col("e.as") == "system", F.col(f"system.{c}")).otherwise(F.col(c)).alias(c)
                  for c in ("tokens", "role", "text")),
                F.when(F.col("e.as") == "system", F.lit(0)).otherwise(F.col("i")).alias("i"))
        .withColumn("head", F.concat(F.lit("<s>"), escape(F.col("role"), ROLE_CODES), F.lit("\n")))
        .withColumn("body", escape(F.col("text"))))
    inside = Window.partitionBy("conv_id", "to").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    length = F.char_length("head") + F.char_length("body") + 4
    spans = (
        shown.withColumn("start", F.coalesce(F.sum(length).over(inside), F.lit(0)) + F.char_length("head") + 1)
        .withColumn("span", F.when(~F.col("repeated") & (F.col("role") == "assistant"), F.struct(
            F.col("start").cast("int").alias("start"), F.char_length("body").alias("length")))))
    parts = F.array_sort(F.collect_list(F.struct("i", "head", "body", "span")))
    return (
        spans.groupBy("conv_id", F.col("to").alias("window"))
        .agg(parts.alias("p"), F.sum("tokens").alias("n_tokens"),
             F.sum(F.col("repeated").cast("int")).alias("n_repeated"),
             F.sum((~F.col("repeated")).cast("int")).alias("n_new"))
        .select(
            "conv_id", "window",
            F.concat_ws("", F.transform("p", lambda x: F.concat(x.head, x.body, F.lit("</s>")))).alias("formatted"),
            "n_tokens", "n_repeated", "n_new",
            F.filter(F.transform("p", lambda x: x.span), lambda x: x.isNotNull()).alias("loss_spans")))


def read_back(windows: DataFrame) -> DataFrame:
    """From the windows alone: conv_id, turns (role and text, in order, once),
    losses (unescaped texts under the loss mask, in order), formatted_chars."""
    cut = F.split("formatted", F.lit("</s>"))
    new = F.transform(
        F.slice(cut, F.col("n_repeated") + 1, F.col("n_new")),
        lambda t: F.struct(
            unescape(F.substring_index(F.substring(t, F.lit(4), F.char_length(t)), "\n", 1), ROLE_CODES).alias("role"),
            unescape(F.substring(t, F.locate("\n", t) + 1, F.char_length(t))).alias("text")))
    losses = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s.start, s.length)))
    ordered = F.array_sort(F.collect_list(F.struct("window", "new", "losses")))
    return (
        windows.withColumn("new", new).withColumn("losses", losses)
        .groupBy("conv_id").agg(ordered.alias("w"), F.sum(F.char_length("formatted")).alias("formatted_chars"))
        .select("conv_id", F.flatten(F.transform("w", lambda x: x.new)).alias("turns"),
                F.flatten(F.transform("w", lambda x: x.losses)).alias("losses"), "formatted_chars"))


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, from the windows: n_turns, turns_sha256, loss_chars,
    loss_sha256 and formatted_chars."""
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))))
    lost = F.concat_ws("", "losses")
    return read_back(windows).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(lost).cast("long").alias("loss_chars"),
        F.sha2(lost, 256).alias("loss_sha256"), "formatted_chars")
