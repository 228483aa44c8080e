"""What is read and written: landed pages, snapshots, history files, leads."""
