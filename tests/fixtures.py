"""Hand-made inputs with known results."""

import json
from datetime import datetime, timedelta

START = datetime(2026, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


def message(user, product, seller, action, seconds, price):
    fields = {
        "user_id": user,
        "user_city": "Paris",
        "product_id": product,
        "product_cat": "Livres & BD",
        "seller_id": seller,
        "action_type": action,
        "price": price,
    }
    if seconds is not None:
        fields["timestamp"] = at(seconds).strftime("%Y-%m-%dT%H:%M:%SZ")
    return json.dumps(fields)


FOLD = [
    message("u1", "p1", "s1", "AIME", 10, 9.5),
    message("u1", "p1", "s1", "ACHAT", 5, 9.5),
    message("u1", "p1", "s1", "AIME", None, 9.5),
    message("u2", "p1", "s1", "VOUT", 7, 9.5),
    message("u3", "p2", "s2", "SHARE", 8, 3.0),
    "not json",
    message("u2", "p1", "s1", "VOUT", 7, 9.5),
]

# src, dst, score, last_interaction, AIME, VOUT, ACHAT
FOLD_EDGES = [
    ("u1", "p1", 22.0, at(10), 2, 0, 1),
    ("u2", "p1", 10.0, at(7), 0, 2, 0),
]

FOLD_VERTICES = [
    ("p1", "PROD"),
    ("p2", "PROD"),
    ("s1", "SEL"),
    ("s2", "SEL"),
    ("u1", "USER"),
    ("u2", "USER"),
    ("u3", "USER"),
]


def messages(spark, texts):
    return spark.createDataFrame([(t.encode(),) for t in texts], "value binary")


def rows(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in chosen.collect()), key=repr)
