"""Starting streams, and the sinks they write to."""
