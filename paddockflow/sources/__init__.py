"""Record feeds, datagram captures and warehouse tables as DataFrames."""
