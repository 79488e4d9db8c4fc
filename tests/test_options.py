import pytest

from msgflow.options import DEFAULT_DATETIME_FORMAT, SinkOptions, SourceOptions


def test_source_options_typed():
    options = SourceOptions.from_options(
        {
            "path": "/logs/a",
            "stream": "stream",
            "consumer": "durable",
            "create_consumer": "false",
            "ack_wait": "1",
            "max_ack_pending": "7",
            "max_request_batch": "2",
            "subjects": "a,b",
            "batch_size": "5",
            "codec": "zlib",
            "listeners": "3",
            "reset_on_restart": "TRUE",
            "idle_timeout": "6",
        }
    )
    assert options.streams == ("stream",)
    assert options.consumer == "durable"
    assert options.create_consumer is False
    assert (options.ack_wait, options.max_ack_pending, options.max_request_batch) == (1, 7, 2)
    assert options.subjects == ("a", "b")
    assert (options.batch_size, options.codec, options.listeners) == (5, "zlib", 3)
    assert options.reset_on_restart is True
    assert options.idle_timeout == 6.0


def test_source_defaults():
    options = SourceOptions.from_options({"path": "/p", "stream": "s"})
    assert (options.ack_wait, options.max_ack_pending, options.max_request_batch) == (90, 1000, 100)
    assert (options.batch_size, options.listeners, options.codec, options.envelope) == (1000, 1, "none", "full")
    assert options.create_consumer is True and options.ack_none is False and options.reset_on_restart is False
    assert options.consumer is None and options.idle_timeout is None and options.subjects == ()
    assert options.datetime_format == DEFAULT_DATETIME_FORMAT


def test_keys_ignore_case_and_lists_are_trimmed():
    options = SourceOptions.from_options({"PATH": "/p", "Stream_Prefix": "P", "NUM_PARTITIONS": "2", "subjects": " a , ,b,"})
    assert options.streams == ("P-0", "P-1")
    assert options.subjects == ("a", "b")


@pytest.mark.parametrize("missing", ["path", "stream"])
def test_missing_key_is_named(missing):
    given = {"path": "/p", "stream": "s"}
    del given[missing]
    with pytest.raises(ValueError, match=f"'{missing}'"):
        SourceOptions.from_options(given)
    with pytest.raises(ValueError, match=f"'{missing}'"):
        SinkOptions.from_options(given)


@pytest.mark.parametrize(
    "bad",
    [
        {"ack_wait": "soon"},
        {"create_consumer": "yes"},
        {"codec": "lz9"},
        {"envelope": "text4"},
        {"batch_size": "0"},
        {"listeners": "-1"},
        {"idle_timeout": "x"},
    ],
)
def test_bad_values(bad):
    with pytest.raises(ValueError, match=next(iter(bad))):
        SourceOptions.from_options({"path": "/p", "stream": "s", **bad})


def test_sink_options():
    options = SinkOptions.from_options({"path": "/p", "stream": "s", "subjects": "a.>, b", "writer": "w1"})
    assert options == SinkOptions("/p", "s", ("a.>", "b"), "w1")
    assert SinkOptions.from_options({"path": "/p", "stream": "s"}).writer is None
