"""Referral dialogue (ST7), referral records (ST9) and the debt reply.

Parsing runs in Spark: every inbound message gets its candidate reason,
name, postal code, phone and city/state from the Column functions in
``functions.contacts``.

``dialogue_replay`` is the batch form and all JVM. What a message does depends
on the question asked last and on which slots are filled, 18 states in all, and
on which parts its text holds, 17 kinds. So a message is a map from state to
state; maps compose associatively, and a prefix scan over blocks of messages
gives the state before each one, however long a conversation is. The table of
maps is read off ``answer`` itself. The values in the slots are then the last
ones that were set: a running maximum by place.

``dialogue_stream`` is the streaming form (``applyInPandasWithState``) where a
key's state is O(1) and only one micro-batch of its messages is in memory at a
time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from canvass.functions import contacts as C
from canvass.operators.scan import numbered, prior_maxes

# The dialogue's reply texts.
START = "Let's get more people to join in this fight!\n"
ASK_REASON = ("First, in one quick sentence, why are you supporting {candidate}? "
              "We'll share this with people you refer.")
# Who the reason question names; a deployment sets its own.
CANDIDATE = "our candidate"
ASK_NAME = "What's your first and last name?"
RETRY_NAME = "Reply with your first and last name."
ASK_ZIP = "And what's your zip code?"
RETRY_ZIP = "Reply with your 5-digit zip code."
ASK_FRIEND = "What's your friend's first and last name?"
RETRY_FRIEND = "Reply with your friend's first and last name."
ASK_PHONE = "Cool, what's {friend}'s phone number?"
ASK_CITY = "What city and state does {first} live in? For example: Reno NV"
RETRY_CITY = "Reply with your friend's city and state. For example: Fort Dodge IA"
SENT = ("Great, sent an invite to {first}. What's the name of another person you'd like to invite "
        "to join the fight?")



@dataclass(frozen=True)
class Question:
    """One line of the dialogue: what it asks, which parsed parts of an answer
    fill which slots, and what it says to an answer that lacks one of them."""

    name: str
    ask: str
    fills: tuple[tuple[str, str], ...]     # (slot, parsed column)
    needs: tuple[str, ...]                 # slots that must be filled to go on
    retry: str = ""                        # empty: the question itself again
    clears: tuple[str, ...] = ()           # slots emptied when it is asked


FRIEND_SLOTS = ("ref_full", "ref_first", "ref_last", "ref_phone", "ref_city", "ref_state")

QUESTIONS = (
    Question("why", ASK_REASON, (("reason", "_msg"),), ("reason",)),
    Question("who", ASK_NAME, (("full", "_full"), ("first", "_first"), ("last", "_last")), ("first", "last"), RETRY_NAME),
    Question("where", ASK_ZIP, (("postal_code", "_zip"),), ("postal_code",), RETRY_ZIP),
    Question("friend", ASK_FRIEND, (("ref_full", "_full"), ("ref_first", "_first"), ("ref_last", "_last")),
             ("ref_first", "ref_last"), RETRY_FRIEND, FRIEND_SLOTS),
    Question("friend_phone", ASK_PHONE, (("ref_phone", "_phone"),), ("ref_phone",)),
    Question("friend_place", ASK_CITY, (("ref_city", "_city"), ("ref_state", "_st")), ("ref_city", "ref_state"),
             RETRY_CITY, ("ref_city", "ref_state")),
)
PLACE = {q.name: i for i, q in enumerate(QUESTIONS)}

# What is known of a sender beforehand; ``dialogue_replay`` takes it as a table.
PROFILE_SLOTS = ("reason", "full", "first", "last", "postal_code", "email")
SLOTS = ["asked", *PROFILE_SLOTS, *FRIEND_SLOTS]


def parse_messages(df: DataFrame, text: str = "text") -> DataFrame:
    """Candidate slot values of every message, computed in the JVM."""
    t = F.col(text)
    nm = C.split_name(t)
    cs = C.city_state(t)
    return df.select(
        "*", F.trim(F.coalesce(t, F.lit(""))).alias("_msg"),
        nm["full"].alias("_full"), nm["first"].alias("_first"), nm["last"].alias("_last"),
        C.extract_postal_code(t).alias("_zip"), C.extract_phone(t).alias("_phone"),
        cs["city"].alias("_city"), cs["state"].alias("_st"))


def answer(slots: dict, message) -> tuple[str, dict | None]:
    """The reply to one pre-parsed message; ``slots`` is changed. When all
    questions are answered, also the referral: a copy of the slots.

    An empty message, or the first one, starts over: what is known of the
    friend is dropped, and the first open question is asked. Otherwise the
    message answers the question asked last.
    """
    text = message["_msg"] or None
    again = text is not None and slots["asked"] is not None
    reply = "" if again else START
    if not again:
        slots.update(dict.fromkeys(FRIEND_SLOTS))
    for question in QUESTIONS[PLACE[slots["asked"]] if again else 0:]:
        if text is not None:
            parsed = {slot: message[part] for slot, part in question.fills}
            text = None
            if all(parsed[slot] for slot in question.needs):
                slots.update(parsed)
            elif question.retry:
                slots["asked"] = question.name
                return reply + question.retry, None
        if not all(slots[slot] for slot in question.needs):
            slots.update(dict.fromkeys(question.clears), asked=question.name)
            return reply + question.ask.format(candidate=CANDIDATE, friend=slots["ref_full"], first=slots["ref_first"]), None
    referral = dict(slots)
    slots.update(dict.fromkeys(FRIEND_SLOTS), asked="friend")
    return reply + SENT.format(first=referral["ref_first"]), referral


OUT_SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("reply", T.StringType()), T.StructField("state_after", T.StringType()),
    T.StructField("referral_sent", T.BooleanType()),
    *[T.StructField(f"referee_{k}", T.StringType()) for k in ("full", "first", "last", "phone", "city", "state")],
    *[T.StructField(f"referrer_{k}", T.StringType()) for k in ("full", "first", "last", "postal_code", "email", "reason")],
])


def _record(conv, turn, reply: str, s: dict, sent: dict | None) -> dict:
    sent = sent or {}
    return {"conv_id": conv, "turn": turn, "reply": reply, "state_after": s["asked"],
            "referral_sent": bool(sent),
            "referee_full": sent.get("ref_full"), "referee_first": sent.get("ref_first"),
            "referee_last": sent.get("ref_last"), "referee_phone": sent.get("ref_phone"),
            "referee_city": sent.get("ref_city"), "referee_state": sent.get("ref_state"),
            **{f"referrer_{k}": sent.get(k) for k in ("full", "first", "last", "postal_code", "email", "reason")}}


def _rows(key, pdf: pd.DataFrame, s: dict) -> list[dict]:
    out = []
    for m in pdf.sort_values("turn", kind="stable").to_dict("records"):
        reply, sent = answer(s, m)
        out.append(_record(key, m["turn"], reply, s, sent))
    return out


_PARSED_COLS = ["conv_id", "turn", "_msg", "_full", "_first", "_last", "_zip", "_phone", "_city", "_st",
                *[f"_known_{k}" for k in PROFILE_SLOTS]]


def _begin(m) -> dict:
    """The slots of a conversation before its first message."""
    return dict.fromkeys(SLOTS) | {k: m[f"_known_{k}"] or None for k in PROFILE_SLOTS}


def _with_profiles(messages: DataFrame, profiles: DataFrame | None) -> DataFrame:
    """Messages (conv_id, turn, text) with what the profiles (conv_id and any of PROFILE_SLOTS) know of the sender."""
    known = [k for k in PROFILE_SLOTS if profiles is not None and k in profiles.columns]
    if known:
        messages = messages.join(profiles.select("conv_id", *[F.col(k).cast("string").alias(f"_known_{k}") for k in known]).dropDuplicates(["conv_id"]),
                                 "conv_id", "left")
    return messages.withColumns({f"_known_{k}": F.lit(None).cast("string") for k in PROFILE_SLOTS if k not in known})


# ------------------------------------------------------------ batch: maps between states
# Groups of slots that are filled together, by the question that fills them.
OWN, FRIEND = ("why", "who", "where"), ("friend", "friend_phone", "friend_place")
# Parts that a text may hold, in the order of a kind's bits; kind 0 is an empty text.
PARTS = (("_first", "_last"), ("_zip",), ("_phone",), ("_city", "_st"))
KINDS = 1 + (1 << len(PARTS))
BLOCK = 64  # maps composed in one row


class _Said(str):
    """A stand-in that came with the message, not from a slot."""


def _try(state: tuple, kind: int) -> tuple:
    """``answer`` on stand-ins: next state, reply, the questions whose slots were set, and whether a referral was sent."""
    asked, filled = state
    slots = dict.fromkeys(SLOTS) | {"asked": asked}
    shown = {"_full": "{friend}", "_first": "{first}"}     # how a reply shows them
    have = filled | set(FRIEND[:FRIEND.index(asked)] if asked in FRIEND else ())
    for q in QUESTIONS:
        if q.name in have:
            slots.update({slot: shown.get(part, "?") for slot, part in q.fills})
    message = dict.fromkeys(["_msg", "_full", *[c for part in PARTS for c in part]])
    if kind:
        said = {"_msg", *[c for bit, part in enumerate(PARTS) if (kind - 1) >> bit & 1 for c in part]}
        said |= {"_full"} if "_first" in said else set()
        message.update({c: _Said(shown.get(c, "?")) for c in said})
    reply, referral = answer(slots, message)
    used = referral or slots
    done = frozenset(q.name for q in QUESTIONS if all(isinstance(used[slot], _Said) for slot in q.needs))
    return (slots["asked"], frozenset(q for q in OWN if all(slots[s] for s in QUESTIONS[PLACE[q]].needs))), reply, done, referral is not None


def dialogue_states() -> tuple[list[tuple], list[list[tuple]]]:
    """All states that can be reached, the eight beginnings first, and for each state and kind what ``_try`` gives."""
    states = [(None, frozenset(q for i, q in enumerate(OWN) if known >> i & 1)) for known in range(1 << len(OWN))]
    steps = []
    for state in states:  # grows while it is walked
        row = [_try(state, kind) for kind in range(KINDS)]
        states += [s for s in dict.fromkeys(r[0] for r in row) if s not in states]
        steps.append([(states.index(to), *rest) for to, *rest in row])
    return states, steps


def _numbers(values, kind: str = "int") -> Column:
    """A literal array, as one expression (hundreds of single literals are slow to build)."""
    return F.expr(f"cast(array({', '.join(str(v).lower() for v in values)}) as array<{kind}>)")


def _kind() -> Column:
    """Which parts a message's text holds."""
    def said(c: str) -> Column:
        return F.coalesce(F.length(c) > 0, F.lit(False))
    bits = [F.when(reduce(lambda a, b: a & b, [said(c) for c in part]), 1 << i).otherwise(0) for i, part in enumerate(PARTS)]
    return F.when(said("_msg"), 1 + reduce(lambda a, b: a + b, bits)).otherwise(0)


def _beginning() -> Column:
    """The state of a conversation before its first message, by what the profile knows."""
    def known(*slots: str) -> Column:
        return reduce(lambda a, b: a & b, [F.coalesce(F.length(f"_known_{s}") > 0, F.lit(False)) for s in slots])
    return sum((F.when(known(*QUESTIONS[PLACE[q]].needs), 1 << i).otherwise(0) for i, q in enumerate(OWN)), F.lit(0))


def states_before(rows: DataFrame, begins: DataFrame, n_states: int) -> DataFrame:
    """conv_id, rn, state: the state before each map of ``rows`` (conv_id, rn from 1, map: next state of every state).

    ``begins`` has conv_id and state. ``BLOCK`` maps in a row compose to one;
    the composed ones are scanned in the same way, so a conversation of n
    messages takes log n rounds and no row holds more than a block.
    """
    blocks = rows.groupBy("conv_id", F.floor((F.col("rn") - 1) / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("rn", "map"))).alias("members")).checkpoint()
    several = blocks.where("block > 0").select("conv_id").distinct()
    if several.isEmpty():
        at = blocks.join(begins, "conv_id")
    else:
        identity = _numbers(range(n_states), "tinyint")
        composed = F.aggregate("members", identity, lambda acc, m: F.transform(acc, lambda s: F.get(m["map"], s)))
        long = blocks.join(several, "conv_id", "left_semi").select("conv_id", (F.col("block") + 1).alias("rn"), composed.alias("map"))
        within = states_before(long, begins, n_states).select("conv_id", (F.col("rn") - 1).alias("block"), "state")
        first = blocks.where("block = 0").join(begins, "conv_id")
        at = first.unionByName(blocks.where("block > 0").join(within, ["conv_id", "block"]))
    empty = F.array().cast("array<struct<rn:bigint,state:int>>")
    walked = F.aggregate("members", F.struct(F.col("state").cast("int").alias("now"), empty.alias("seen")), lambda acc, m: F.struct(
        F.get(m["map"], acc["now"]).cast("int").alias("now"),
        F.concat(acc["seen"], F.array(F.struct(m["rn"].cast("bigint").alias("rn"), acc["now"].alias("state")))).alias("seen")))
    return at.select("conv_id", F.inline(walked["seen"]))


def dialogue_replay(messages: DataFrame, key: str = "conv_id", turn: str = "turn", text: str = "text",
                    profiles: DataFrame | None = None) -> DataFrame:
    """ST7 batch replay: one reply (and state) per inbound message.

    Rows without conversation or turn have no place in a talk and are left out;
    equal turns are taken in the order of their texts. Nothing runs in Python,
    and no task holds a whole conversation.
    """
    rows = messages.select(F.col(key).alias("conv_id"), F.col(turn).alias("turn"), F.col(text).alias("text")).where(
        "conv_id is not null and turn is not null")
    # places first: range bounds come from a sample, which would parse every message once more
    placed = parse_messages(_with_profiles(numbered(rows, ["conv_id"], ["turn", "text"]), profiles), "text").select(*_PARSED_COLS, "rn")
    placed = placed.checkpoint().withColumns({"_kind": _kind(), "_begin": _beginning()})
    states, steps = dialogue_states()
    maps = F.array(*[_numbers([row[kind][0] for row in steps], "tinyint") for kind in range(KINDS)])
    begins = placed.where("rn = 1").select("conv_id", F.col("_begin").alias("state"))
    before = states_before(placed.select("conv_id", "rn", F.get(maps, F.col("_kind")).alias("map")), begins, len(states))
    flat = [step for row in steps for step in row]
    texts = list(dict.fromkeys(step[1] for step in flat))
    step = F.col("state") * KINDS + F.col("_kind")
    done = placed.join(before, ["conv_id", "rn"]).withColumns({
        "_text": F.get(F.array(*[F.lit(x) for x in texts]), F.get(_numbers([texts.index(s[1]) for s in flat]), step)),
        "_next": F.get(_numbers([s[0] for s in flat]), step), "referral_sent": F.get(_numbers([s[3] for s in flat], "boolean"), step)})
    # what each message sets, with its place: the latest is in force
    values = {q.name: F.struct("rn", *[F.col(part).alias(slot) for slot, part in q.fills]) for q in QUESTIONS}
    done = done.withColumns({f"_set_{q}": F.when(F.get(_numbers([q in s[2] for s in flat], "boolean"), step), v) for q, v in values.items()})
    done = prior_maxes(done, ["conv_id"], "rn", {f"_was_{q}": f"_set_{q}" for q in values})
    now = {q: F.greatest(f"_was_{q}", f"_set_{q}") for q in values}

    def own(q: str, slot: str) -> Column:
        return F.when(F.col("referral_sent"), F.coalesce(now[q][slot], F.nullif(F.col(f"_known_{slot}"), F.lit(""))))

    friend = {"full": "friend", "first": "friend", "last": "friend", "phone": "friend_phone", "city": "friend_place", "state": "friend_place"}
    reply = F.col("_text")
    for mark, slot in (("{friend}", "ref_full"), ("{first}", "ref_first")):
        reply = F.replace(reply, F.lit(mark), F.coalesce(now["friend"][slot], F.lit("")))
    return done.select(
        "conv_id", "turn", reply.alias("reply"),
        F.get(F.array(*[F.lit(asked) for asked, _ in states]), F.col("_next")).alias("state_after"), "referral_sent",
        *[F.when(F.col("referral_sent"), now[q][f"ref_{k}"]).alias(f"referee_{k}") for k, q in friend.items()],
        *[own(q, k).alias(f"referrer_{k}") for k, q in (("full", "who"), ("first", "who"), ("last", "who"), ("postal_code", "where"))],
        F.when(F.col("referral_sent"), F.nullif("_known_email", F.lit(""))).alias("referrer_email"),
        own("why", "reason").alias("referrer_reason"))


STATE_SCHEMA = T.StructType([T.StructField(k, T.StringType()) for k in SLOTS])


def dialogue_stream(messages: DataFrame, key: str = "conv_id", turn: str = "turn", text: str = "text",
                    profiles: DataFrame | None = None) -> DataFrame:
    """ST7 streaming form: slot state per key across micro-batches."""
    rows = messages.select(F.col(key).alias("conv_id"), F.col(turn).alias("turn"), F.col(text).alias("text"))
    p = parse_messages(_with_profiles(rows, profiles), "text").select(*_PARSED_COLS)

    def handle(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # Arrow chunks of a key come in no order, so its micro-batch is sorted here
        chunks = [b for b in batches if len(b)]
        if not chunks:
            return
        pdf = pd.concat(chunks, ignore_index=True)
        s = dict(zip(SLOTS, state.get)) if state.exists else _begin(pdf.iloc[0])
        rows = _rows(int(k[0]), pdf, s)
        state.update(tuple(s[x] for x in SLOTS))
        yield pd.DataFrame(rows, columns=OUT_SCHEMA.fieldNames())
    return p.groupBy("conv_id").applyInPandasWithState(handle, OUT_SCHEMA, STATE_SCHEMA, "append",
                                                       GroupStateTimeout.NoTimeout)


def referrals(replies: DataFrame, referrer_phone: str = "conv_id") -> DataFrame:
    """ST9: get-or-create referral on (referee phone, referrer): the latest
    send's details win, ``first_turn`` keeps when it was created. Invalid
    referee phones never reach here (the dialogue rejects them)."""
    sent = replies.filter("referral_sent")
    cols = ["referee_full", "referee_first", "referee_last", "referee_city", "referee_state",
            "referrer_full", "referrer_first", "referrer_last", "referrer_postal_code", "referrer_email"]
    g = sent.groupBy(F.col(referrer_phone).alias("referrer"), "referee_phone").agg(
        F.max_by(F.struct(*cols), "turn").alias("_r"), F.min("turn").alias("first_turn"),
        F.max("turn").alias("last_turn"))
    return g.select("referrer", "referee_phone", *[F.col("_r")[c].alias(c) for c in cols], "first_turn", "last_turn")
