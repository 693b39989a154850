"""The jobs, as plans over tables and as tasks from paths to paths."""
