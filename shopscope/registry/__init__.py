"""The query catalogue over the warehouse tables, and its SQL counterparts."""
