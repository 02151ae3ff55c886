"""Message streams: decode JSON messages, project them, write them out."""

from gleaner.streaming.messages import (decode_messages, kafka_messages, latest_changelog, message_schema, project_messages,
                                        publish, run_stream, tumbling_counts, write_changelog)

__all__ = ["decode_messages", "kafka_messages", "latest_changelog", "message_schema", "project_messages", "publish",
           "run_stream", "tumbling_counts", "write_changelog"]
