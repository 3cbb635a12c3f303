import numpy as np
import pytest

from helmwake.llm.sentences import NEVER, OUTPUT, STEP, abbreviations, cut, document_sentences, pieces, run, sentence_units
from helmwake.session import table

CASES = [
    ["The drone held 28.9 m.", "It drifted, cf. Sec. 72 of v. 1.3.8."],
    ['"Do we have a fix?" asked J. R. Pellmoor from St. Orla.', 'She said, "Climb."', "Good."],
    ["The spotter (who stood there!) missed it.", "(See Fig. 4 for the view.)", "Stop!"],
    ["Wait... is that the cone?", "Path clear…", "41 frames were dropped.", "dTrack lost its lock."],
    ["We landed at 3:21 p.m.", "The crew brought cones, etc.", "After 7:33 p.m. the light faded."],
    ["Am 7. Mai fiel das Bild aus.", "Laut Plan bzw. Karte z. B. links, d. h. weit.", "„Halt!“, rief er.", "Im Bericht steht: „Der Weg ist frei.“", "Ende."],
    ["«¿Quién movió el cono?», preguntó la Dra. Ormaiz.", "¡Alto!", "A las 3:33 p. m. empezó.", "¿Hay más?"],
    ["« Restez au sol ! » a crié M. Tavernoux.", "Le rapport dit : « La voie est libre. »", "Quel désordre !", "Qui a vu ?"],
    ["Ветер стих, и дрон вернулся к отметке\n35.", "Инженер Б. К. Тарвелин проверил 66 кадров, т. е. больше.", "«Стоп!» — крикнул он.", "Батарея села… полёт прервали."],
    ["Πόσα μέτρα απέχει;", "Ο δρ. Βελοράν σημείωσε 12 λάθη.", "Η απόσταση ήταν περ. 6 μέτρα· ο άνεμος δυνάμωσε."],
    ["انتبه!", "سجل د. فالوران 4 أخطاء.", "كم مترا يفصلنا؟", "ارتفعت السرعة؛ ثم هدأت."],
    ["डॉ. वेलोरन ने 14 त्रुटियाँ लिखीं।", "बैटरी बची थी… उड़ान रोकी गई।", "रुको!"],
]
CJK = ["记录员写道：“路径畅通。”", "听到“停！”的口令后，飞手松开了摇杆。", "她说“再靠近一点”，然后关掉了电源。", "为什么消失了？！", "再向前飞72米……", "转换器V1.1.4取整到17.9秒。", "第No.4号机降落。"]
JA = ["「止まれ。」と操縦者が叫んだ。", "残り24％だった……", "なぜ消えたのか？", "地図（第56版）では、右側。", "No.85の機体は着陸した。"]
THAI = ["ภาพหายไป 3 เฟรมหลังผ่านประตู", "แบตเตอรี่เหลือ 47 เปอร์เซ็นต์", "ลมแรงขึ้น"]


def units(t):
    return [t[a:b] for a, b in cut([t])[0]]


@pytest.mark.parametrize("want", CASES)
def test_languages_with_spaces(want):
    assert units(" ".join(want)) == want
    assert units("\n".join(want)) == want


@pytest.mark.parametrize("want,sep", [(CJK, ""), (JA, ""), (THAI, " "), (CJK, "\n")])
def test_scripts_without_spaces_or_marks(want, sep):
    assert units(sep.join(want)) == want


def test_blank_lines_headings_and_list_marks():
    t = "Run summary\n \n1. Fr. Dr. Ellermuth prüfte.\r\n2. Ende\r\n\r\n• Stop!\n(3) Gate B.4 is closed\n\n  \n- Last"
    assert units(t) == ["Run summary", "1. Fr. Dr. Ellermuth prüfte.", "2. Ende", "• Stop!", "(3) Gate B.4 is closed", "- Last"]


def test_missing_space_and_names():
    assert units("Stop!The drone held episode_1.png.What a flight? See README.md, U.S.-style info.json?! Yes.") == ["Stop!", "The drone held episode_1.png.", "What a flight?", "See README.md, U.S.-style info.json?!", "Yes."]
    assert units('He saw the "goal."Nobody moved.') == ['He saw the "goal."', "Nobody moved."]


def test_marks_that_meet():
    assert units('记录员写道：“路径畅通。”"Do we have a fix?" asked J. R. Pellmoor. Stop!') == ["记录员写道：“路径畅通。”", '"Do we have a fix?" asked J. R. Pellmoor.', "Stop!"]
    assert units("Le rapport dit : « La voie est libre.\n» La suite.") == ["Le rapport dit : « La voie est libre.\n»", "La suite."]
    assert units("He said (“No.”) Then he left.") == ["He said (“No.”)", "Then he left."]


def test_places_are_code_points_without_outer_space():
    t = "　📷 Marker 👩‍🚀 stayed.  \tNext one.\n"
    assert cut([t]) == [[(1, 21), (24, 33)]] and units(t) == ["📷 Marker 👩‍🚀 stayed.", "Next one."]


def test_nothing_visible():
    assert cut(["", " \t\n　", "\n\n\n"]) == [[], [], []]


def test_chunks_compose_like_one_run():
    rng = np.random.default_rng(0)
    s = rng.integers(0, 11, 5000).astype(np.uint8)
    state, want = 0, []
    for x in s:
        want.append(bool(OUTPUT[x, state]))
        state = STEP[x, state]
    for chunk in (1, 7, 256, 8192):
        assert run(s, chunk).tolist() == want


def test_long_text_and_many_texts():
    one = "The drone held 28.9 m. \"Do we have a fix?\" asked J. R. Pellmoor. 记录员写道：“路径畅通。”停！\n\n"
    assert len(units(one * 5000)) == 4 * 5000
    assert cut([one, "", one]) == [cut([one])[0], [], cut([one])[0]]


def test_documents(spark, data, clashing):
    t = table(spark, data, "documents")
    want = {tuple(r) for r in document_sentences(t).collect()}
    assert want and {tuple(r) for r in document_sentences(clashing(t)).collect()} == want
    text = {r["doc_id"]: r["text"] for r in t.collect()}
    assert all(r["sentence"] == text[r["doc_id"]][r["sent_start"] : r["sent_end"]] for r in sentence_units(t).collect())
    # nothing visible is left outside the sentences
    for i, x in text.items():
        spans = sorted((a, b) for j, a, b in want if j == i)
        rest = "".join(x[b:a] for (_, b), (a, _) in zip([(0, 0), *spans], [*spans, (len(x or ""), 0)])) if x else ""
        assert not rest.strip()
    assert document_sentences(t.limit(0)).count() == 0


def test_abbreviations_are_learned_from_the_documents(spark):
    """None of these is in the seed; words that only ever end sentences are not learned."""
    held = {"gov": "Gov. Smith", "sen": "Sen. Warren", "sig": "Sig. Rossi", "jan": "Jan. 3", "resp": "resp. Karte", "u.k": "U.K. Navy"}
    assert not set(held) & NEVER
    rng = np.random.default_rng(3)
    lines = []
    for i in range(3000):
        k = list(held.values())[i % len(held)]
        lines.append(f"He met {k} near the {rng.choice(['goal', 'gate', 'ramp'])}. The drone went {rng.choice(['left', 'up', 'down'])}. All was fine. The gate, ramp and goal at left went up and down to a fine land. We saw it land." + ("\n\n" if i % 3 == 0 else " "))
    docs = spark.createDataFrame([(i, "".join(lines[i * 30 : i * 30 + 30])) for i in range(100)], "doc_id bigint, text string")
    learned = abbreviations(docs)
    assert set(held) <= learned and not learned & {"goal", "gate", "ramp", "left", "up", "down", "fine", "land"}
    got = document_sentences(docs).groupBy("doc_id").count().collect()
    assert all(r["count"] == 150 for r in got)
    assert abbreviations(docs.limit(0)) == NEVER


def test_tokens_without_a_vowel_are_no_words():
    assert units("We climbed Mt. Everest with Sgt. Pepper. See blz. 5. It was 12 mm. The end. Turn on the TV. Good.") == ["We climbed Mt. Everest with Sgt. Pepper.", "See blz. 5.", "It was 12 mm.", "The end.", "Turn on the TV.", "Good."]


def test_end_marks_of_other_scripts():
    assert units("သွားပါ။ ရပ်ပါ။") == ["သွားပါ။", "ရပ်ပါ။"]
    assert units("ទៅមុខ។ ឈប់។") == ["ទៅមុខ។", "ឈប់។"]
    assert units("ወደ ፊት ሂድ። ቁም።") == ["ወደ ፊት ሂድ።", "ቁም።"]
    assert units("Զգույշ։ Կանգ։") == ["Զգույշ։", "Կանգ։"]


PARTS = ["The drone held 28.9 m. ", '"Do we have a fix?" asked J. R. Pellmoor. ', "记录员写道：“路径畅通。”停！", "Wait... is that the cone?\n\n", "ลมแรงขึ้น ภาพหายไป 3 เฟรม ", "« Restez ! » a crié M. T. ", "   \n  ", "«Стоп!» — крикнул он. ", "「止まれ。」と叫んだ。"]


def test_pieces_of_a_long_text_compose_to_the_whole(spark):
    rng = np.random.default_rng(11)
    texts = ["".join(rng.choice(PARTS, 400)) for _ in range(4)] + ["x" * 3000 + ". Y" + "z" * 900, "." * 2000 + " A b. C d", " " * 5000, "a " * 4000, None, ""]
    assert all([t[a:b] for t in texts if t for a, b in pieces(t, 100)]) and "".join(texts[0][a:b] for a, b in pieces(texts[0], 7)) == texts[0]
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts + texts[:1])], "doc_id bigint, text string")
    want = sorted(map(tuple, document_sentences(docs).collect()))
    for size in (50, 700, 10**6):
        assert sorted(map(tuple, document_sentences(docs, size).collect())) == want
