from weekly_mart.sources.landing import read_raw, write_csv  # noqa: F401
from weekly_mart.sources.workspace import Workspace, checkpoint_root  # noqa: F401
