import pytest

from tessitura.llm import residue as R

BAD = {
    "filler": ["Lorem ipsum dolor sit amet velit. donec nunc tellus.", "nội dung mẫu " * 8, "asdf qwer 123 asdf zxcv", "placeholder text placeholder text placeholder text"],
    "blank": ["Kính gửi [Họ và tên],\nPhụ đề đã xong.", "Tác giả: undefined\nTiêu đề: null", "Người dịch: ........; Ghi chú: [to be filled].", "Gửi ___________,\nBài đã xong."],
    "page": ["HTTP 502 Bad Gateway\nWe could not load this transcript.", "Vui lòng bật JavaScript trên máy của bạn để tiếp tục.", "Xin mở JS trong trình duyệt để đọc lời bài hát.", "Rất tiếc, trang này không tồn tại. Quay về trang chủ."],
    "marker": ["Bài hát {{title}} qua giọng {{ host }} trình bày. Hay lắm.", "Chào mừng đến với ${ten_bai}!", "Nguồn: <TEN_KENH> / Ngày: <DATE>", "Liên hệ __TITLE__ và @@date@@."],
}
GOOD = [
    "Chúng tôi hát ở bến sông. #phude #radio",
    "[Điệp khúc]\nGió về bến cũ\n{tiếng đàn}\nthuyền neo lại",
    "Giá vé là $12, giảm 50% cho nhóm {ba người} <3 nhé [vỗ tay].",
    "Dân dàn trang hay dùng đoạn lorem ipsum để thử phông, còn kênh này dùng ca dao.",
    "Hôm qua trang nghe thử báo lỗi 503 suốt buổi, may mà nhóm kỹ thuật đã sửa xong.",
    "She sings about a page not found, a love returned as error 404.",
    "Tập này hướng dẫn bật JavaScript trên trình duyệt cũ, rồi nói vì sao trình phát nhạc cần đến nó.",
    "Không ai đến None of us slept in the booth.",
    "la la la la",
]


def test_find(spark):
    docs, want = [], {}
    for reason, texts in BAD.items():
        for t in texts:
            want[len(docs)] = reason
            docs.append((len(docs), t))
    docs += [(100 + i, t) for i, t in enumerate(GOOD)]
    # a wording whose marker never varies is a text about templates
    docs += [(200 + i, "In the workshop we explain why a template such as {0} must be filled before upload.") for i in range(5)]
    docs += [(300, None), (301, ""), (302, "  ")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id bigint, text string, reason string, n int")
    got = {r.doc_id: r.reason for r in R.find_residue(df, "doc_id", "text").collect()}
    assert got == want
    assert R.without_residue(df, "doc_id", "text").count() == len(docs) - len(want)
    assert R.without_residue(df, "doc_id", "text").columns == df.columns
    assert R.find_residue(df.limit(0), "doc_id", "text").count() == 0


@pytest.mark.parametrize("text", ["x " * 100_000, "{{ " * 20_000, "a" * 300_000])
def test_long(text):
    assert isinstance(R.slots(text), list) and isinstance(R.filler(text + " y z w q"), str)


@pytest.mark.parametrize("n", [1, 3, 8])
def test_slot_is_residue_whatever_its_support(spark, n):
    same = [(i, "Bài hát {{title}} qua giọng cô ca sĩ trẻ trình bày.") for i in range(n)]
    other = [(100 + i, f"Tập số {{0}} của kênh Bến Gỗ, thu lần {i} ở nhà.") for i in range(n)]
    df = spark.createDataFrame(same + other, "doc_id bigint, text string")
    assert {r.doc_id: r.reason for r in R.find_residue(df, "doc_id", "text").collect()} == {i: "marker" for i, _ in same + other}


def test_copies_are_no_evidence(spark):
    weak = "Trang {} không tồn tại. Cô bán hoa kể lại chuyện dài về chiếc loa hỏng ở quán đầu ngõ cho cả xóm nghe."
    copies = [(i, weak.format(7)) for i in range(5)]
    df = spark.createDataFrame(copies, "doc_id bigint, text string")
    assert R.page(weak.format(7))[0] == 1 and R.find_residue(df, "doc_id", "text").count() == 0
    df = spark.createDataFrame(copies + [(10, weak.format(8)), (11, weak.format(9))], "doc_id bigint, text string")
    assert R.find_residue(df, "doc_id", "text").count() == 7


_TRACE = 'Unhandled exception: could not load the transcript.\nTraceback (most recent call last):\n' + "".join(
    f'  File "/srv/app/part_{i}.py", line {i}, in handle_request\n    return self.next_step(request, depth={i}, retry=False)\n' for i in range(12)
) + "ConnectionError: connection refused by the host"
_LINE = "error 502 bad gateway while the proxy waited for the upstream host at node 17 of pool 3 the server did not answer in time and the request was dropped connection reset by peer please try again later or report trace id 77ab to the people who run this service"
_PARAGRAPH = "Đây là đoạn chữ giữ chỗ cho phần lời giới thiệu của kênh nghe đài buổi tối ở bến sông. "


@pytest.mark.parametrize("text", [_TRACE, "Hệ thống đang bảo trì, vui lòng quay lại sau. " * 40, _LINE, "không tìm thấy trang " * 60])
def test_pages_of_any_length(text):
    assert len(text) > R.UNIT and R.page(text)[0] == 2


def test_real_texts_of_any_length_are_no_pages():
    said = "nếu trước buổi phát sóng bác bán phở không tìm thấy tệp phụ đề thì chẳng ai cười không ngớt khi cô ca sĩ trẻ nhắc đến bản tin thời tiết cả xóm thấy lòng nhẹ hẳn đừng hỏi vì sao bác bán phở hẹn gặp lần sau vào đúng giờ cơm vì nhịp trống lệch nên đội biên tập phải dựng lại bài hát ru"
    assert R.page(said)[0] < 2 and R.page("Chúng tôi hát ở bến sông cho cả xóm nghe. " * 30 + "Đường truyền bị gián đoạn.")[0] < 2


@pytest.mark.parametrize("text,is_filler", [(_PARAGRAPH * 3, True), ("một hai ba bốn năm sáu bảy tám chín mười gió mây sông núi " * 8, True), ("một hai ba bốn năm sáu bảy tám chín mười gió mây sông núi " * 3, False)])
def test_filler_of_any_period(text, is_filler):
    assert bool(R.filler(text)) is is_filler


def test_periods_are_linear():
    assert list(R.periods(["x"] * 60_000 + [str(i) for i in range(60_000)])) == []


def test_long_weak_pages_are_voted(spark):
    weak = "Mã lỗi {}. " + " ".join(f"Dòng thứ {w} của tờ giấy dán trên tường bến sông vẫn còn nguyên." for w in "ab cd ef gh ij kl mn op qr st uv wx".split())
    df = spark.createDataFrame([(i, weak.format(i)) for i in range(3)] + [(9, _TRACE), (10, _PARAGRAPH * 4)], "doc_id bigint, text string")
    assert len(weak) > 700 and {r.doc_id: r.reason for r in R.find_residue(df, "doc_id", "text").collect()} == {0: "page", 1: "page", 2: "page", 9: "page", 10: "filler"}


def test_prefilter_passes_messages():
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = [*BAD["page"], _TRACE, _LINE, "x. 404 y", "Xin lỗi.\n503", "410 Gone"]
    assert all(pc.match_substring_regex(pa.array(texts), R.MAY_FAIL).to_pylist())


NEW = [
    "Hello [FIRSTNAME], welcome back to the evening show on the river.",
    "Dear CUSTOMER_FIRST_NAME, your caption file is ready for review.",
    "Your recording |*SHOW_LABEL*| was approved by the studio.",
    "Oops! Something went wrong on our end.",
    "Erreur 404. La page demandée est introuvable.",
    "お探しのページが見つかりません。(404)",
    "Fehler 500: Die Seite wurde nicht gefunden.",
]
TAIL = ["The tea seller waited for the train.", "We sang until the lamps went out.", "Nobody asked who kept the tape."]


def test_unseen_wordings_are_found_when_they_recur(spark):
    docs = [(10 * k + j, t.replace("LABEL", ("HOST", "LABEL", "DAY")[j]) + (" " + TAIL[j] if k < 3 else "")) for k, t in enumerate(NEW) for j in range(3)]
    docs += [(900 + j, "[CHORUS] " + x) for j, x in enumerate(TAIL)] + [(950 + j, "[MUSIC] We sang. **Loud** and <i>long</i><br><br>" + x) for j, x in enumerate(TAIL)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: (r.reason, r.via) for r in R.find_residue(df, "doc_id", "text").collect()}
    assert got == {10 * k + j: ("marker", "aligned" if k == 2 else "repeated") if k < 3 else ("page", "repeated") for k in range(7) for j in range(3)}
    once = spark.createDataFrame([(k, t) for k, t in enumerate(NEW)], "doc_id bigint, text string")
    assert R.find_residue(once, "doc_id", "text").count() == 0


def test_most_rows_come_by_alignment(spark):
    """A template whose slots keep names is induced; a fixed sentence about a marker isn't, however often it recurs."""
    names = ["title", "host", "so_tap", "kenh"]
    docs = [(i, f"Bản thu của {{{{{n}}}}} do {{{{ {names[i - 1]} }}}} trình bày. Câu {i}.") for i, n in enumerate(names)]
    docs += [(50 + i, f"Câu lệnh in ra {{{{title}}}} được giảng kỹ. Câu {i}.") for i in range(9)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {(r.doc_id, r.reason, r.via) for r in R.find_residue(df, "doc_id", "text").collect()} == {(i, "marker", "aligned") for i in range(4)}
