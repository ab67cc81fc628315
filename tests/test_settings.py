import pytest

from millrace import Settings
from millrace.settings import LAYERS


@pytest.mark.parametrize("root", ["hdfs:///lake", "hdfs:///lake/", "gs://sales/x"])
@pytest.mark.parametrize("layer", LAYERS)
def test_each_layer_is_a_folder_below_the_root(root, layer):
    found = Settings(root, kafka_topic="orders").layer(layer)
    assert found == f"{root.rstrip('/')}/{layer}" + ("/orders" if layer == "topic" else "")


def test_unknown_layers_are_refused():
    with pytest.raises(ValueError, match="gold"):
        Settings().layer("gold")


def test_only_a_positive_timeout_drains_and_stops():
    assert [Settings(kafka_consumer_timeout_ms=n).stop_when_idle for n in (-1, 0, 1)] == [False, False, True]
