from pyspark.sql import functions as F

from tabsync.functions import (backfill_key, csv_boolean, display_name, fingerprint_label, has_key, is_blank, is_email,
                               looks_like_id, mask_email, trimmed)


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_white_space_of_every_kind_is_stripped(frame):
    df = frame("c string", ("\t x \n",), ("  y　﻿",), ("a b",), (" \t",), (None,))
    assert one(df, trimmed("c")) == ["x", "y", "a b", "", None]
    assert one(df, is_blank("c")) == [False, False, False, True, True]
    assert one(df, has_key("c")) == [True, True, True, True, False]  # white space counts as a key here


def test_id_shape_is_anchored(frame):
    df = frame("c string", ("a" * 15,), ("a" * 18,), ("a" * 16,), ("a" * 15 + "\n",), (None,))
    assert one(df, looks_like_id("c")) == [True, True, False, False, False]


def test_mask_is_idempotent_and_leaves_other_text(frame):
    df = frame("c string", (" a.b+c@x.org ",), ("a@x.org.invalid",), ("not one",), ("a@b",), (None,))
    once = df.select(mask_email("c").alias("c"))
    assert one(once, "c") == ["a.b+c@x.org.invalid", "a@x.org.invalid", "not one", "a@b", None]
    assert one(once.select(mask_email("c").alias("c")), "c") == one(once, "c")
    assert one(df, is_email("c")) == [True, True, False, False, False]


def test_backfill_and_booleans(frame):
    df = frame("id string, k string, b boolean", ("0123456789abcdefgh", None, True), ("x", "", False), ("y", "k", None))
    assert one(df, backfill_key("k", "id", "P")) == ["P-0123456789abcde", "", "k"]
    assert one(df, csv_boolean("b")) == ["TRUE", "FALSE", None]


def test_display_name(frame):
    df = frame("a string, b string", (None, "x"), ("", "x"))
    assert one(df, display_name(["a", "b"])) == ["x", ""]


def test_fingerprint_keeps_fields_apart(frame):
    df = frame("a string, b string", (None, "x"), ("x", None), ("", "x"), ("1|b=2", "3"), ("1", "2|b=3"))
    labels = one(df, fingerprint_label(df, ["a", "b"]))
    assert labels[0] == labels[2]  # null and the empty string are the same
    assert len(set(labels)) == 4


def test_fingerprint_of_numbers(frame):
    df = frame("a double, t timestamp", (0.0, None), (-0.0, None))
    assert len(set(one(df, fingerprint_label(df, ["a", "t"])))) == 1
    fine = frame("i int", (1,), (2,)).select(
        F.expr("timestamp_micros(1000000000000000 + i)").alias("t"))
    assert len(set(one(fine, fingerprint_label(fine, ["t"])))) == 2  # microseconds count
