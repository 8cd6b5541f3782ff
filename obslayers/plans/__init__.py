"""Complete jobs, from source to sink."""
