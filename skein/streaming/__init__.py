from skein.streaming.sources_split import start_sequence_stream, start_split_stream
from skein.streaming.unpivot_stream import (
    start_batch_stream,
    start_sink,
    start_unpivot_stream,
    stream_files,
    stream_workbooks,
)

__all__ = [
    "start_batch_stream",
    "start_sequence_stream",
    "start_sink",
    "start_split_stream",
    "start_unpivot_stream",
    "stream_files",
    "stream_workbooks",
]
