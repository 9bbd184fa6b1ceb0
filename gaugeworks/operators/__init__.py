from gaugeworks.operators.cells import reading_cells
from gaugeworks.operators.dimension import ensure, insert_ignore
from gaugeworks.operators.lookup import lookup_join
from gaugeworks.operators.median import fold_cells

__all__ = ["ensure", "fold_cells", "insert_ignore", "lookup_join", "reading_cells"]
