import datetime as dt

import pytest
from pyspark.sql import functions as F

from docketlab.functions import dates as D, extract as X, lists as L, similarity as M, text as T
from docketlab.operators import cases, pii


@pytest.fixture
def one(spark):
    def run(values, f, kind="string"):
        """f over a one-column table of values."""
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r.o for r in rows.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]

    return run


def test_officer_names(one):
    given = ["Police Officer II Fernando Cuevas", "Sgt. John Smith", "K-9 Handler Anthony Haidet", "John Smith #3446", "[Name Redacted]", None, "Officer", "Detective J. Doe (badge 12)"]
    assert one(given, T.clean_officer_name) == ["Fernando Cuevas", "John Smith", "Anthony Haidet", "John Smith", "", "", "", "J. Doe"]
    assert one(["Officers", "A. Marks", "[Redacted]", "John Smith", None, "K9 Rex", "He was involved in", "involved in it", "Ann Lee, B."], T.invalid_name) == [True, True, True, False, True, True, False, True, False]


def test_case_ids_and_persons(one):
    assert one(["IA2018-017", "ia2018-17", "OIS-001", "RD #99-092462", "F 0754", "000", None], T.case_id) == ["IA2018017", "IA201817", "OIS1", "RD99092462", "F754", "0", ""]
    assert one(["Officer John Smith", "Doe, J.", "Mary-Ann", "Sgt. Smith"], T.person_name) == ["john smith", "doe j", "mary ann", "sgt smith"]
    assert one([["Officer Al Bo", "al bo", None, "x"]], T.person_name_set, "array<string>") == [["al bo"]]
    assert one(["iad_552 "], T.metadata_case_id) == ["IAD-552"] and one(["Officer John Smith", "sheriff"], T.metadata_name) == ["john smith", "sheriff"]


def test_name_lists_and_parts(one):
    assert one(["A B, C D", "Ann Lee and Bo Poe", "X Y/Z W", "Solo"], T.split_names) == [["A B", "C D"], ["ann lee", "bo poe"], ["X Y", "Z W"], ["Solo"]]
    got = one(["john q. public jr.", "f. lopez", "rudy c", "lopez", "a b c d iii"], T.name_parts)
    assert [tuple(r) for r in got] == [("john", "q", "public", "jr"), ("f", "", "lopez", ""), ("rudy", "c", "", ""), ("", "", "lopez", ""), ("a", "b c", "d", "iii")]


def test_paths_and_text(one):
    assert one(["a/b/c/x.pdf"], lambda c: T.shared_depth(c, F.lit("a/b/d/y.pdf"))) == [2]
    assert one(["a/b/c/x.pdf", "x.pdf", None], lambda c: T.directory_at(c, 1)) == ["a/b", "", ""]
    assert one(["N.PDF", "none"], T.extension) == [".pdf", ""]
    assert one(["Updated summary: x\n\n\n\ny", "RESPONDING AGENCIES:\nNo responding agencies identified on this page.\n"], T.scrub_summary) == ["x\n\ny", ""]
    assert one(["No date in this", " ", "Officer shot"], T.meaningful_summary) == [False, False, True]
    assert one(["x"], lambda c: T.render("a $v $$ $other ${v}.", v=c)) == ["a x $ $other x."]
    assert one(["```json\n{}\n```"], T.strip_fences) == ["{}"]
    assert one(["Sheriff's Office / DA", "County DA", "Medical Examiner", "Police", None], T.is_not_law_enforcement) == [False, True, True, False, False]


def test_dates(one):
    given = {"2024-01-15": "2024-01-15", "1/5/2024": "2024-01-05", "20240115": "2024-01-15", "021320": "2020-02-13", "January 15, 2024": "2024-01-15", "jan 5, 2024": "2024-01-05", "01/15/69": "1969-01-15", "15.08.03": None, "12:30": None, "2024-13-45": None, "13132020": None, "01212021": "2021-01-21", "20/08/23": "2020-08-23", "x": None, None: None, "1850-01-01": None}
    got = one(list(given), D.parse_date)
    assert [str(g) if g else None for g in got] == list(given.values())
    assert one(["3/1/2019, 2021-05-05", "in 1999 or 2004", "none"], D.latest_year) == [2021, 1999, None]
    assert one(["20200101-20200105,20200301"], D.range_dates) == [["2020-01-01", "2020-01-05", "2020-03-01"]]
    assert one([["2020-01-01", "2021-01-01"], []], lambda c: D.least_gap(c, F.array(F.lit("2020-01-06"))), "array<string>") == [5, -1]
    assert one([[]], lambda c: D.within_days(c, c, required=True), "array<string>") == [False]


def test_metadata(one):
    assert one(["Case 2020-01-02_03.04.21 on January 5th, 2019"], X.metadata_dates)[0][:2] == ["January 5th, 2019", "2020-01-02"]
    assert one(["IAD2018-017 report 21-021-0129 F313 Case#AB-9", "109 V1"], X.metadata_ids) == [["IAD2018-017", "AB-9", "21-021-0129"], []]
    assert one(["Officer John Smith and Hourigan, K - Chief of Police, victim One Two Jr."], X.metadata_names) == [["Hourigan, K", "John Smith and"]]
    assert one(["take 3, 1 and 9, 3"], lambda c: X.answer_indices(c, 5, 2)) == [[3, 1]]


def test_lists(one):
    assert one(["['a', 'b']", '["a", "b"]', "['a', None]", '{"x": "1", "y": "2"}', "a, b", "solo", "", None], L.text_list) == [["a", "b"], ["a", "b"], ["a"], ["1", "2"], ["a", "b"], ["solo"], [], []]
    assert one(["[0]", "7", "[]", "x"], L.cluster_id) == [0, 7, None, None]
    assert one(["[1, 2.5]", "[ 1. 2. ]", "a b", ""], L.text_vector) == [[1.0, 2.5], [1.0, 2.0], None, None]
    assert one(["A, B"], lambda c: L.agencies_to_check(F.lit("X"), c)) == [["X", "A, B"]]
    assert one(['[{"page": 1, "page_content": "p"}, {"page_number": 2, "text": "q"}]', '{"messages": [{"page": 3, "text": "r"}]}', "raw"], L.whole_text) == ["p\n\nq", "r", "raw"]
    assert one([[1, 2, 3, 4, 5], []], L.chunks, "array<int>") == [[[1, 2, 3, 4], [5]], []]


@pytest.mark.parametrize("a,b,want", [("martha", "marhta", 0.961111), ("dixon", "dicksonx", 0.813333), ("dwayne", "duane", 0.84), ("", "a", 0.0), ("abc", "xyz", 0.0), ("same", "same", 1.0)])
def test_jaro_winkler(a, b, want):
    assert M.jaro_winkler_value(a, b) == pytest.approx(want, abs=1e-6)


def test_fuzzy():
    assert M.keep_distinct(["Oakland Police Department", "Oakland Police Dept", "Fresno PD", "Fresno PD"]) == ["Oakland Police Department", "Fresno PD"]
    assert M.token_sort_value("Smith, John", "john smith") == 100


def test_string_features(one):
    null, empty = one([None, ""], lambda c: M.string_features(c, c))
    assert tuple(null) == (0.0, 1.0, 0.0) and tuple(empty) == (0.0, 1.0, 1.0)
    assert tuple(one(["J"], lambda c: M.component_similarity(c, F.lit("james"), initials=True))[0]) == (1.0, True)


def test_cards(one):
    given = ["pay 4111 1111 1111 1111 now", "4111-1111 1111-1111", "x4111111111111111", "378282246310005", "3056-9309-0259-04 3600 0000 0000 08", "4111.1111.1111.1112", None]
    assert one(given, pii.has_card) == [True, False, False, True, True, False, False]
    assert one(["6011111111111117"], pii.cards)[0][0].brand == "Discover"
    assert one(["a 123-45-6789 xyz", "123-45-6789"], pii.has_ssn) == [True, False]


def test_birth_dates(one):
    given = ["DOB: 01/15/1985", "Date of Birth (MM/DD/YYYY): 1/2/85", "born on\nJanuary 15, 1985", "DOB: see file of 01/15/1985", "DOB\n\n\n01/15/1985", "DOBSON 01/15/1985", "D.O.B. 15 Jan 1985", "the date 01/15/1985", None]
    assert one(given, pii.has_birth_date) == [True, False, True, False, True, True, True, False, False]


def test_birth_labels_are_looked_for_once(spark):
    df = spark.createDataFrame([("born on 1/2/1985, DOB see file",), ("date of birth: x\nDOB 5 March 1990",), ("Birthday 1/2/1985",)], "t string")
    assert [r.dob for r in df.select(pii.has_birth_date("t").alias("dob")).collect()] == [True, True, False]
    assert str(pii.has_birth_date("t")).count("regexp_extract_all") == len(pii.BIRTH_LABELS)


def test_row_rules(one):
    assert one(["n/a", "x?", "Case 1", None], cases.assigned) == [False, False, True, False]
    assert one([" 20na ", "na", None], cases.number_part) == [20.0, None, None]
    assert one(["yes", "False", "perhaps", None], T.tristate) == ["TRUE", "FALSE", "UNCLEAR", "UNCLEAR"]
    assert one(["2020-01-02T03:04:05+02:00", "", "bad"], D.naive_timestamp)[:3] == [dt.datetime(2020, 1, 2, 1, 4, 5), None, None]
