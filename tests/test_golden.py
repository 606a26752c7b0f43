"""Golden edge cases (FIXTURES.md section 4): expected values follow the rules
of the original tool, restated here as literal rows."""

from pyspark.sql import functions as F

from parlance.functions import metadata as M
from parlance.functions.tags import safe_names, ud_feature, vocab
from parlance.functions.text import fix_missing_colon, leading_label, words
from parlance.operators import frequency as FQ
from parlance.operators import lines as L
from parlance.operators import models as MD
from parlance.operators import verify as V


def one_col(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_submission_normalisation(spark):
    df = one_col(spark, ["submission1", "submission123.txt", "submission12345", "submission000012", "submission00"])
    got = [r[0] for r in df.select(M.normalize_submission("x")).collect()]
    assert got == ["submission0001", "submission0123.txt", "submission12345", "submission0012", "submission0000"]


def test_parse_lines(spark):
    chunks = spark.createDataFrame([(1, 0, "  PARTICIPANT: 00:00:01.000 hi\n\n b: c:d ")], "file_id long, chunk long, c string") \
        .select("file_id", "chunk", F.split("c", "\n", -1).alias("lines"))
    got = [tuple(r) for r in L.parse_lines(L.raw_lines(chunks)).orderBy("line_index")
           .select("line_index", "speaker", "ts", "text").collect()]
    assert got == [(1, "PARTICIPANT", "00:00:01.000", "hi"), (2, "UNKNOWN", "", "c:d")]


def test_colon_fix(spark):
    df = spark.createDataFrame([("PARTICIPANT b", False), ("INTERVIEWER: x", False), ("PARTICIPANT", False),
                                ("PARTICIPANT", True)], "raw string, last boolean")
    got = [r[0] for r in df.select(fix_missing_colon("raw", F.col("last"))).collect()]
    assert got == ["PARTICIPANT: b", "INTERVIEWER: x", "PARTICIPANT:", "PARTICIPANT"]


def test_colon_fix_other_line_breaks(spark):
    # a label after \r, U+0085 or U+2028 is not at a line start of the file (only \n splits)
    df = one_col(spark, ["x\rPARTICIPANT a", "x\u0085PARTICIPANT a", "x PARTICIPANT a"])
    got = [r[0] for r in df.select(fix_missing_colon("x")).collect()]
    assert got == ["x\rPARTICIPANT a", "x\u0085PARTICIPANT a", "x PARTICIPANT a"]


def test_leading_label(spark):
    df = spark.createDataFrame([("S1: a", False), ("SP b", False), ("S12x", False), ("S2", False), ("S2", True)],
                               "raw string, last boolean")
    got = [r[0] for r in df.select(leading_label("raw", F.col("last"))).collect()]
    assert got == ["S1", "SP", "", "S2", ""]


def test_parse_roles(spark):
    df = one_col(spark, ["S1: INTERVIEWER\nS2: PARTICIPANT",
                         "S1: interviewer S1: participant S2: INTERVIEWER",
                         "S1: INTERVIEWER", "S1: INTERVIEWER S2: PARTICIPANT S3: PARTICIPANT", ""])
    got = [r[0] for r in df.select(MD.parse_roles("x")).collect()]
    as_dict = [None if g is None else {e["speaker"]: e["role"] for e in g} for g in got]
    assert as_dict == [{"S1": "INTERVIEWER", "S2": "PARTICIPANT"}, {"S1": "PARTICIPANT", "S2": "INTERVIEWER"},
                       None, None, None]


def test_parse_interview_type(spark):
    df = one_col(spark, ["junk {psychs}", "maybe OPEN or PSYCHS", "OPENED", ""])
    got = [r[0] for r in df.select(MD.parse_interview_type("x")).collect()]
    assert got == ["PSYCHS", "PSYCHS", None, None]


def test_ud_feature(spark):
    df = one_col(spark, ["Number=Sing|Number[psor]=Plur", "Mood=Ind", None])
    got = [tuple(r) for r in df.select(ud_feature("x", "Number"), ud_feature("x", "Mood")).collect()]
    assert got == [("psor]=Plur", ""), ("", "Ind_mood"), ("", "")]


def test_filename_fields_missing_tokens(spark):
    df = one_col(spark, ["a_b"])
    r = df.select(M.patient_id("x"), M.transcript_type("x"), M.day("x"), M.session("x")).first()
    assert tuple(r) == ("b", None, None, None)


def test_corrected_name(spark):
    df = spark.createDataFrame([("X_1_t_psychs_day1_s.txt",), ("X_1_t_PSYCHS_day1_s.txt",)], "x string")
    got = [r[0] for r in df.select(M.corrected_name("x", F.lit("PSYCHS"), F.lit("OPEN"))).collect()]
    assert got == ["X_1_t_open_day1_s.txt", "X_1_t_PSYCHS_day1_s.txt"]


def test_mean_log_frequency_no_word_found(spark):
    units = spark.createDataFrame([(1, "Participant", "en", "zzz", 3)],
                                  "file_id long, speaker_role string, lang string, word string, n long")
    lex = spark.createDataFrame([("en", "abc", 10000)], "lang string, word string, lg_e4 long")
    r = FQ.mean_log_frequency(units, lex).first()
    assert (r["word_freq"], r["found"], r["missing"]) == (None, 0, 3)


def test_lexicon_last_row_wins(spark):
    lex = spark.createDataFrame([("May", 0.1, 1.0, 0), ("may", 0.2, 2.0, 1), ("MAY", 0.3, 3.0, 2)],
                                "word string, frequency double, log_frequency double, pos long")
    r = FQ.lexicon_dictionary(lex, "pos").first()
    assert (r["word"], r["value"]) == ("may", 3.0)


def test_accuracy_without_units(spark):
    v = spark.createDataFrame([], "filename string, first_row_index long, expected string, predicted string, verdict string")
    r = V.accuracy(v).first()
    assert r["processed"] == 0 and r["accuracy"] is None


def test_words_python_semantics(spark):
    df = one_col(spark, ["Don't stop—the café's\tNAÏVE  x_y 42!"])
    assert df.select(words("x")).first()[0] == ["dont", "stopthe", "cafés", "naïve", "x_y", "42"]


def test_vocabulary_and_safe_names():
    v = vocab()
    assert len(v) == 102 and v[:3] == ["1", "2", "3"]
    names = safe_names()
    assert names["1"] == "p1" and names["Yes"] == "pronoun_possession"
    assert len({n.lower() for n in names.values()}) == 102


def test_site_and_path_rules(spark):
    df = spark.createDataFrame([("PronetYA_YA1_x", "/a/CHR/hc/Language.de/f.txt"),
                                ("PrescientZZ_1", "/a/b/en/f.txt"), ("HKxx_2", "/chronic/x/f.txt")],
                               "name string, path string")
    got = [tuple(r) for r in df.select(M.site_code("name"), M.clinical_group_from_path("path"),
                                       M.language_from_path("path")).collect()]
    assert got == [("YA", "HC", "de"), (None, "UNKNOWN", "en"), ("HK", "CHR", "UNKNOWN")]


def test_first_n_per_language_exact(spark):
    rows = [(f"f{i:03d}", "en" if i % 5 else "de") for i in range(200)]
    df = spark.createDataFrame(rows, "file_name string, language string")
    got = sorted(tuple(r) for r in V.first_n_per_language(df, 3, salt_buckets=7).collect())
    exp = sorted([(n, l) for l in ("en", "de") for n in sorted(n for n, x in rows if x == l)[:3]])
    assert got == exp


def test_relabel_is_simultaneous(spark):
    """S0/S1/S2 become S1/S2/S3 in one step (no chain S0 -> S1 -> S2)."""
    from parlance.operators import labels as LB
    raw = spark.createDataFrame([(1, 1, "S0: a", False), (1, 2, "S1: b", False), (1, 3, "S2 c", True)],
                                "file_id long, raw_index long, raw string, is_last boolean")
    lab = LB.line_labels(raw)
    out = LB.normalize_labels(lab, LB.label_mapping(lab)).orderBy("raw_index").select("raw").collect()
    assert [r[0] for r in out] == ["S1: a", "S2: b", "S3: c"]
