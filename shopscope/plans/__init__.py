"""The named analytics. Each takes cleaned DataFrames and returns a lazy one.

Frames used throughout:

``transactions``  one row per transaction (header)
``lines``         one row per transaction item, with its header columns
``sessions``      one row per session, with its element counts
``views``         one row per product viewed in a session
``carts``         one row per product in a session's cart

``users.user_id``, ``products.product_id``, ``transactions.transaction_id`` and
``sessions.session_id`` are unique; ``operators.keyed.duplicate_keys`` checks it.
Every analytic aggregates before it joins where that gives the same rows, so a
hot user or product is reduced to one row per task before it is shuffled.
"""
