"""Word counts of the sample lines."""

from helpers import rows
from tidelog.operators.words import word_count
from tidelog.sources.files import read_lines

# Sample lines and their expected counts.
LANGUAGES = ["python python java", "shell java javascript", "C C++ C# SQL",
             "SQL java scala java python html"]
WHO = ["Who's there?", "I think I hear them. Stand, ho! Who's there?"]


def test_words(spark):
    got = dict(rows(word_count(read_lines(spark, default=LANGUAGES))))
    assert got == {"java": 4, "python": 3, "c": 3, "sql": 2, "shell": 1, "javascript": 1,
                   "scala": 1, "html": 1}


def test_space_separated(spark):
    got = dict(rows(word_count(read_lines(spark, default=WHO), split="space")))
    assert got == {"Who's": 2, "there?": 2, "I": 2, "think": 1, "hear": 1, "them.": 1,
                   "Stand,": 1, "ho!": 1}


def test_empty_tokens(spark):
    df = read_lines(spark, default=["a  b ", " a", "", "   ", "b\n"])
    assert dict(rows(word_count(df, split="space"))) == {"a": 2, "b": 1, "b\n": 1, "": 3}


def test_several_inputs(spark, tmp_path):
    for name, text in (("one", "a b"), ("two", "b c")):
        (tmp_path / name).write_text(text)
    df = read_lines(spark, [str(tmp_path / "one"), str(tmp_path / "two")])
    assert dict(rows(word_count(df))) == {"a": 1, "b": 2, "c": 1}
