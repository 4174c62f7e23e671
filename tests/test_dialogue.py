"""Referral dialogue: invented conversations, batch replay and stream alike."""

import os
import random
import re
import tempfile

from canvass.operators import dialogue as DG

WHY = DG.ASK_REASON.format(candidate=DG.CANDIDATE)
# (message, question open afterwards, reply)
TALK = [
    ("We need clean rivers", "who", DG.START + DG.ASK_NAME),          # a first message is the reason
    ("Ines", "who", DG.RETRY_NAME),
    ("ines okafor", "where", DG.ASK_ZIP),
    ("no idea", "where", DG.RETRY_ZIP),
    ("it is 50309 I think", "friend", DG.ASK_FRIEND),
    ("Otto Brandt", "friend_phone", DG.ASK_PHONE.format(friend="Otto Brandt")),
    ("he has none", "friend_phone", DG.ASK_PHONE.format(friend="Otto Brandt")),
    ("then 515 555 0133", "friend_place", DG.ASK_CITY.format(first="Otto")),
    ("somewhere", "friend_place", DG.RETRY_CITY),
    ("Ames Iowa", "friend", DG.SENT.format(first="Otto")),
    ("Mia Lund", "friend_phone", DG.ASK_PHONE.format(friend="Mia Lund")),
    ("", "friend", DG.START + DG.ASK_FRIEND),                         # starts over; own slots are kept
    ("Mia", "friend", DG.RETRY_FRIEND),
    ("Mia Lund", "friend_phone", DG.ASK_PHONE.format(friend="Mia Lund")),
    ("5155550144", "friend_place", DG.ASK_CITY.format(first="Mia")),
    ("Pella, IA", "friend", DG.SENT.format(first="Mia")),
]


def _messages(spark, key=7):
    return spark.createDataFrame([(key, i, m) for i, (m, _, _) in enumerate(TALK)], "conv_id long, turn long, text string")


def test_batch_replay(spark):
    out = sorted(DG.dialogue_replay(_messages(spark)).collect(), key=lambda r: r["turn"])
    assert [(r["state_after"], r["reply"]) for r in out] == [(q, want) for _, q, want in TALK]
    sent = [(r["referee_full"], r["referee_phone"], r["referee_city"], r["referee_state"], r["referrer_first"], r["referrer_last"],
             r["referrer_postal_code"], r["referrer_reason"]) for r in out if r["referral_sent"]]
    own = ("Ines", "Okafor", "50309", "We need clean rivers")
    assert sent == [("Otto Brandt", "15155550133", "Ames", "IA", *own), ("Mia Lund", "15155550144", "Pella", "IA", *own)]
    refs = DG.referrals(DG.dialogue_replay(_messages(spark))).collect()
    assert sorted(r["referee_phone"] for r in refs) == ["15155550133", "15155550144"]


def test_empty_first_message_asks_and_known_slots_are_skipped(spark):
    rows = spark.createDataFrame([(1, 0, ""), (2, 0, ""), (3, 0, None)], "conv_id long, turn long, text string")
    known = spark.createDataFrame([(2, "Because", "Ana Diaz", "Ana", "Diaz", "50010", "ana@example.org"),
                                   (3, "Because", None, None, None, "50010", None)],
                                  "conv_id long, reason string, full string, first string, last string, postal_code string, email string")
    got = {r["conv_id"]: (r["state_after"], r["reply"]) for r in DG.dialogue_replay(rows, profiles=known).collect()}
    assert got == {1: ("why", DG.START + WHY), 2: ("friend", DG.START + DG.ASK_FRIEND), 3: ("who", DG.START + DG.ASK_NAME)}


def test_stream_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="canvass-dialogue-")
    src = os.path.join(root, "in")
    msgs = _messages(spark)
    for lo, hi in ((0, 5), (5, 11), (11, 16)):     # three micro-batches in turn order
        msgs.filter(f"turn >= {lo} AND turn < {hi}").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(msgs.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (DG.dialogue_stream(stream).writeStream.format("parquet").option("path", os.path.join(root, "out"))
         .option("checkpointLocation", os.path.join(root, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(spark.read.schema(DG.OUT_SCHEMA).parquet(os.path.join(root, "out")).collect(),
                 key=lambda r: r["turn"])
    assert [r["reply"] for r in got] == [want for _, _, want in TALK]


def plain_replay(rows, known):
    """Every conversation walked message by message with ``answer``."""
    out = {}
    for conv in {r["conv_id"] for r in rows}:
        slots = dict.fromkeys(DG.SLOTS) | {k: v or None for k, v in known.get(conv, {}).items()}
        for m in sorted((r for r in rows if r["conv_id"] == conv), key=lambda r: r["turn"]):
            reply, sent = DG.answer(slots, m)
            out[conv, m["turn"]] = (reply, slots["asked"], sent)
    return out


def test_state_maps_equal_a_walk(spark):
    """Random talks, one of them much longer than a block of maps (and of blocks), against the message-by-message rule."""
    rng = random.Random(4)
    says = ["", None, "  ", "Because", "Ana Diaz", "otto VAN DER BERG", "50309", "515 555 0133", "Ames IA", "Fort Dodge, Iowa",
            "Mia Lund 50010 515-555-0144 Pella IA", "x"]
    good = ["Because", "Ana Diaz", "50309", "Mia Lund", "515 555 0133", "Ames IA"]
    talks = []
    for conv in range(40):
        n, script = (5000, 3) if conv == 0 else (rng.randint(1, 90), 0)
        for turn in range(n):
            talks.append((conv, 3 * turn - 7, good[turn % len(good)] if rng.random() < 0.7 else rng.choice(says)))
    rows = spark.createDataFrame(talks, "conv_id long, turn long, text string")
    known = {c: {"reason": "r" if c % 2 else "", "first": "A" if c % 3 else None, "last": "B", "full": "A B", "postal_code": "50010" if c % 5 else None,
                 "email": f"{c}@example.org"} for c in range(0, 40, 2)} | {1: dict.fromkeys(DG.PROFILE_SLOTS, "known")}
    profiles = spark.createDataFrame([(c, *[v[k] for k in DG.PROFILE_SLOTS]) for c, v in known.items()],
                                     "conv_id long, " + ", ".join(f"{k} string" for k in DG.PROFILE_SLOTS))
    parsed = DG.parse_messages(rows).toPandas().astype(object).to_dict("records")
    want = plain_replay(parsed, known)
    got = DG.dialogue_replay(rows.repartition(8), profiles=profiles).collect()
    assert len(got) == len(want) and sum(r["referral_sent"] for r in got) > 300
    for r in got:
        reply, asked, sent = want[r["conv_id"], r["turn"]]
        assert (r["reply"], r["state_after"], r["referral_sent"]) == (reply, asked, sent is not None)
        for k in ("full", "first", "last", "phone", "city", "state"):
            assert r[f"referee_{k}"] == (sent or {}).get(f"ref_{k}")
        for k in ("full", "first", "last", "postal_code", "email", "reason"):
            assert r[f"referrer_{k}"] == (sent or {}).get(k)


def test_replay_plan_has_no_python_and_odd_rows_are_left_out(spark):
    rows = spark.createDataFrame([(None, 1, "x"), (1, None, "x"), (1, 1, None), (1, 2, "Because")], "conv_id long, turn long, text string")
    out = DG.dialogue_replay(rows)
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())
    assert sorted((r["turn"], r["state_after"]) for r in out.collect()) == [(1, "why"), (2, "who")]
    assert DG.dialogue_replay(rows.limit(0)).count() == 0
