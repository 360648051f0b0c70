"""The fold in Spark's state store."""

from bazaargraph.sources import events as sources
from bazaargraph.streaming import fold_store
from fixtures import FOLD, FOLD_EDGES, rows
from test_streams import NOW, Inbox


def test_state_goes_on_after_a_restart(spark, tmp_path):
    inbox = Inbox(spark, tmp_path)
    checkpoint = f"{inbox.root}/checkpoint"
    for texts in (FOLD[:3], FOLD[3:5], FOLD[5:]):
        for text in texts:
            inbox.put([text])
        query = fold_store.start_fold_stream(
            sources.parse_events(inbox.messages()), checkpoint, triggers=NOW
        )
        query.awaitTermination()
    assert rows(fold_store.read_fold(spark, checkpoint)) == FOLD_EDGES
    heavy = fold_store.read_fold(spark, checkpoint, {"AIME": 1.0, "VOUT": 100.0, "ACHAT": 20.0})
    assert rows(heavy, "src", "score") == [("u1", 22.0), ("u2", 200.0)]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != fold_store.PROVIDER
