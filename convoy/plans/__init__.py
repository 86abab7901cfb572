"""Jobs: the daily extract, detection, the dashboard, and ad-hoc questions."""
