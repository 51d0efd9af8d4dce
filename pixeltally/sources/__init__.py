"""Reading and writing files, the partitioned lake and warehouse tables."""
