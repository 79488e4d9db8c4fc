"""msgflow: persistent message streams as Spark tables, streams and DataFrame operators."""

from importlib import import_module

# Public names and the modules they live in; loaded on first use.
_EXPORTS = {
    "MessageLog": "msgflow.sources.log",
    "Delivery": "msgflow.operators.delivery",
    "SourceOptions": "msgflow.options",
    "SinkOptions": "msgflow.options",
    "read_stream": "msgflow.sources.reading",
    "each_batch": "msgflow.sources.reading",
    "register": "msgflow.sources.reading",
    "publish": "msgflow.sources.sink",
    "write_stream": "msgflow.sources.sink",
    "relay_stream": "msgflow.streaming.relay",
    "relay_table": "msgflow.streaming.relay",
    "redeliver": "msgflow.streaming.redelivery",
    "redeliveries": "msgflow.streaming.redelivery",
    "stop_when_idle": "msgflow.streaming.idle",
}


def __getattr__(name: str):
    if name in _EXPORTS:
        return getattr(import_module(_EXPORTS[name]), name)
    raise AttributeError(name)
