from weekly_mart.streaming.incremental import load_new_files  # noqa: F401
