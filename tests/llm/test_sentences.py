"""Sentence ends in many languages, on texts that the model was not fitted on."""

import pytest

from weftline.llm import sentences

DATA = "/root/testdata/sf0.01/documents.parquet"

MARKED = {
    "abbreviations": "Dr. Talen Roverton holds a Ph.D. and lives in St. Marion Street.| It was not!| No. 12 was withdrawn.|",
    "numbers": "The sum of EUR 308,818.41 (i.e. 93.39 times the deposit) fell due at 5 p.m. on 27 June 2021.| It was not!|",
    "quotation": "The witness, Dr. Talen Rover, stated: “I never signed the lease.”| The U.S. exhibit, signed “Rover Jr.” in red ink, was set aside.|",
    "dots": "Rover J. would have stayed the pension ... but joined in the result.| Le pourvoi est donc rejeté...| La cour répond par la négative.|",
    "german": "Am 1. Verhandlungstag wurde der Vertrag vorgelegt (Bl. 447 ff. d. A.).| Der Streitwert beträgt 915.675,22 EUR, d. h. rund 36,50 v. H. der Forderung.|",
    "german quotes": "„Warum“, fragte Talen Rover, „wurde der Grenzstein nicht vorgelegt?“| Der Senat folgt dem nicht.|",
    "french": "« Pourquoi ? », demande Me T. Rover, « le brevet est nul. »|  Le pourvoi est donc rejeté...| V. not. Rep. 24, 434 (725), p. 394 et s.|",
    "spanish": "¿Por qué se aportó el registro núm. 883?| ¡No lo era!| El Sr. Rover y la Sra. Talen reclaman 7,5 EUR.|",
    "greek": "Ήταν το μητρώο έγκυρο;| Το δικαστήριο δεν το δέχεται.| Η κ. Rover κατέθεσε στις 5 μ.μ. ότι το μητρώο ήταν ελλιπές.|",
    "hindi": "दावे की राशि रु. 87.97 लाख है।| डॉ. Rover ने कहा, “मैंने यह पट्टा नहीं देखा।”| अपील खारिज की जाती है।|",
    "arabic": "هل كان السجل وقتئذ صحيح ؟| انظر الطعن رقم 613/4، ص. 46.| متى وقع Rover على الإخطار؟|",
    "chinese": "该担保书当时是否逾期？|“该货物不完整！”Rover当庭表示，但未提交证据。|证人Rover陈述：“我从未见过该界桩。”|（货物不在本案审理范围之内。）|利率按年5.2%计算……|本院不予采信。|",
    "japanese": "「船荷証券は不完全か。」「存じません。」との応答があった。|（なお、帳簿は本件の対象ではない。）|利息は年9.4％と思われる……|よって、本件帳簿は有効である。|",
    "thai": "คดีหมายเลข 378/1978 ไม่เกี่ยวกับหนังสือ| จำเลยชำระเงิน 84.22 ล้านบาทแล้ว| โจทก์ยื่นอุทธรณ์เมื่อวันที่ 3 มีนาคม 2005 คัดค้านคำสั่ง|",
    "no blank": "The claim was for interest until payment.|It was not!|The lease itself was withdrawn.|",
}


@pytest.fixture(scope="module")
def splitter(spark):
    rows = spark.read.parquet(DATA).where("text IS NOT NULL").orderBy("doc_id").select("text").collect()
    return sentences.Splitter(sentences.fit([r.text for r in rows]))


@pytest.mark.parametrize("name", MARKED)
def test_language(splitter, name):
    text, ends = MARKED[name].replace("|", ""), []
    for part in MARKED[name].split("|")[:-1]:
        ends.append((ends[-1] if ends else 0) + len(part))
    assert splitter.ends(text) == ends


def test_furniture(splitter):
    parts = ["High Court of Nowhere", "K 12/20", "between A and K.", "Headnote", "It was not!", "Judgment", "(Rn. 5) It was\nnot! No. 7", "K 12/20 · High Court · p. 2", "was withdrawn.", "Page 3 of 5", "(Rn. 6) It was not!", "Order", "It was not!", "Rover, Talen, Marion"]
    text = "\n\n".join(parts)
    ends = splitter.ends(text)
    assert [text[:e].split("\n\n")[-1][-12:] for e in ends] == ["It was not!", " It was\nnot!", "s withdrawn.", ") It was not!"[-12:], "It was not!"]


def test_odd_texts(splitter):
    assert splitter.ends("") == [] and splitter.ends(" \n\n ") == []
    assert splitter.ends("Headnote") == []
    assert splitter.ends("It was not!" * 3000)[-1] == 33_000
    for text in ("...", "?!", "“”", "a. b. c.", "\n\n\n", "🙂. 🙂!", "1. ", "§ 4 "):
        assert all(0 < e <= len(text) for e in splitter.ends(text))


def test_held_out_paragraphs(spark):
    """Joins of paragraphs of texts that the model has not seen are found again, and marks before small words are not."""
    rows = [r.text for r in spark.read.parquet(DATA).where("text IS NOT NULL").orderBy("doc_id").select("text").collect()]
    model = sentences.fit(rows[:600])
    splitter = sentences.Splitter(model)
    found, labels = sentences.reliable(rows[600:], splitter.is_prose, model.recurring)
    right = sum(splitter.is_boundary(x) == y for x, y in zip(found, labels))
    assert right / len(labels) > 0.98
    gaps = [(x, y) for x, y in zip(found, labels) if x[0] == " "]
    assert len(gaps) > 100 and sum(splitter.is_boundary(x) == y for x, y in gaps) / len(gaps) > 0.99
    found, labels = sentences.reliable_blocks(rows[600:], model.recurring)
    assert {True, False} == set(labels) and sum(splitter.is_prose(x) == y for x, y in zip(found, labels)) / len(labels) > 0.995


def test_frame(spark):
    df = spark.createDataFrame([(1, "It was not! It was not!"), (1, "It was not!"), (2, None), (3, ""), (None, "It was not!"), (4, "Headnote")], "doc_id bigint, text string").selectExpr("*", "0 AS n", "0 AS end_pos")
    assert sorted(map(tuple, sentences.sentence_ends(df, "doc_id", "text").collect())) == [(1, 11), (1, 11), (1, 23), (4, 8)]  # so few texts teach nothing about headings
    assert sentences.sentence_ends(df.limit(0), "doc_id", "text").count() == 0


def test_model_without_labels():
    model = sentences.fit([])
    assert not model.marks.any() and not model.blocks.any() and not model.recurring
    assert sentences.Splitter(model).ends("No model drops a text") == [21]


def test_thai_after_a_long_quotation(splitter):
    """Thai that begins beyond the first 200 characters of a run has its ends too."""
    thai = "จำเลยชำระเงินแล้ว ศาลเห็นว่าสัญญาเช่าสมบูรณ์ พิพากษายกอุทธรณ์"
    text = "“" + "the register of the apiary was not shown " * 8 + "” " + thai
    assert len(text) - len(thai) > 300
    assert {text.index(" ศาล"), text.index(" พิพากษา"), len(text)} <= set(splitter.ends(text))


def test_thai_gaps_around_numbers(splitter):
    text = "ศาลเห็นว่าสัญญาเช่าสมบูรณ์ โจทก์ยื่นอุทธรณ์เมื่อวันที่ 3 มีนาคม 2005 คัดค้านคำสั่ง พิพากษายกอุทธรณ์"
    assert splitter.ends(text) == [text.index(" โจทก์"), text.index(" พิพากษา"), len(text)]


def test_prose_without_a_final_mark_is_kept(splitter):
    for text in ("The tenant owes the rent and the costs", "The tenant owes the rent and the costs of the proceedings before this court and before the other one", "der Mieter schuldet die Miete und die Kosten"):
        assert splitter.ends(text) == [len(text)]


def test_nothing_around_a_docket_is_lost(splitter):
    """A docket-shaped line among the first blocks makes furniture of no paragraph."""
    text = "\n\n".join(["The first paragraph has a sentence.", "K 12/20", "The body sentence one is here. Another one follows.", "A last one."])
    assert [text[:e].split("\n\n")[-1] for e in splitter.ends(text)] == ["The first paragraph has a sentence.", "The body sentence one is here.", "The body sentence one is here. Another one follows.", "A last one."]


def test_long_quotation(splitter):
    """However long a quotation is, the class of its end is the same."""
    described = []
    for many in (1, 15, 60):
        text = "The witness stated: “" + "I saw the ledger and the deed " * many + "there.” The court agreed."
        end = text.index("” The") + 1
        described.append(dict(sentences.candidates(text))[end][2])
        assert splitter.ends(text) == [end, len(text)]
    assert described == ["i"] * 3


def test_a_sentence_may_begin_in_lower_case(splitter):
    text = "The appeal was withdrawn. which apiary prevails when the loom is lost? It was not, e.g. after the deed of St. Marion was shown."
    assert splitter.ends(text) == [text.index(" which"), text.index("? ") + 1, len(text)]


def test_copies_do_not_fill_the_sample(spark):
    """A third of the rows are one text: the sample holds it once, and every row is split."""
    df = spark.range(300).selectExpr("if(id % 3 = 0, 0L, id) AS doc_id", "if(id % 3 = 0, 'It was not! It was not!', concat('The claim of ', id, ' was withdrawn. It was not!')) AS text")
    rows = sentences.sentence_ends(df, "doc_id", "text", fit_texts=50, fit_chars=2000)
    assert rows.where("doc_id = 0").count() == 200 and rows.count() >= 400
