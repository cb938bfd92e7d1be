"""corpusloom.streaming"""
