from labelgap.streaming.scoring import score_line_stream
from labelgap.streaming.sink import committed_rows, committed_sink, commits

__all__ = ["committed_rows", "committed_sink", "commits", "score_line_stream"]
