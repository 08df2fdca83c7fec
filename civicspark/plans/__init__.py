"""Named clean-ups, views and end-to-end runs."""
