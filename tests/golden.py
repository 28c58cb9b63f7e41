"""Published result tables of the analysed postings, used as expected values."""

MONTHS = ["2025-07", "2025-08", "2025-09", "2025-10", "2025-11", "2025-12", "2026-01", "2026-02", "2026-03"]
TOTALS = [789, 1025, 828, 1071, 934, 884, 925, 704, 805]
KEYWORD_COUNTS = {
    "Python": [200, 304, 237, 300, 295, 268, 279, 228, 256],
    "Java": [309, 367, 296, 381, 307, 310, 316, 228, 240],
    "AWS": [296, 357, 302, 386, 313, 296, 320, 224, 296],
    "React": [198, 250, 210, 271, 224, 211, 232, 169, 181],
    "Spring": [152, 201, 152, 194, 165, 183, 174, 123, 138],
    "Docker": [118, 179, 147, 162, 155, 155, 173, 124, 151],
    "TypeScript": [160, 199, 186, 200, 184, 179, 191, 150, 167],
    "Kubernetes": [104, 167, 130, 141, 157, 133, 142, 115, 147],
    "MySQL": [104, 131, 122, 129, 121, 124, 129, 80, 118],
    "Git": [243, 331, 264, 327, 327, 281, 285, 226, 243],
    "LLM": [75, 108, 81, 109, 110, 82, 132, 113, 137],
    "Go": [145, 228, 164, 192, 178, 188, 193, 142, 178],
    "PostgreSQL": [79, 113, 100, 115, 92, 101, 104, 83, 101],
    "Redis": [78, 98, 84, 110, 111, 113, 93, 73, 92],
    "Kotlin": [85, 94, 85, 93, 99, 88, 95, 71, 87],
    "FastAPI": [39, 42, 29, 63, 42, 45, 46, 46, 61],
    "NestJS": [31, 36, 28, 33, 32, 35, 38, 26, 38],
    "GCP": [83, 125, 116, 154, 101, 109, 109, 78, 95],
    "CI/CD": [177, 198, 191, 206, 208, 203, 201, 145, 191],
    "Linux": [87, 104, 75, 123, 119, 123, 111, 89, 123],
}
# keyword: first period, second period, recent, growth, overall mean
GROWTH = {
    "Linux": (10.1, 12.7, 13.3, 26.2, 12.0), "FastAPI": (4.2, 5.2, 6.4, 23.3, 5.2), "Redis": (9.9, 11.6, 10.6, 18.1, 10.7),
    "Python": (27.9, 30.0, 31.4, 7.5, 29.8), "LLM": (9.9, 10.4, 15.8, 4.7, 12.0), "Git": (31.7, 32.4, 31.0, 2.5, 31.7),
    "GCP": (12.2, 12.5, 11.6, 2.2, 12.1), "Kubernetes": (15.1, 15.0, 16.6, -0.3, 15.6), "CI/CD": (21.6, 21.5, 22.0, -0.5, 21.7),
    "Spring": (19.1, 18.8, 17.8, -1.3, 18.6), "Docker": (16.7, 16.4, 18.4, -1.8, 17.2), "React": (24.9, 24.4, 23.9, -2.3, 24.4),
    "Kotlin": (10.1, 9.7, 10.4, -3.2, 10.1), "PostgreSQL": (11.0, 10.7, 11.9, -3.3, 11.2), "NestJS": (3.6, 3.5, 4.2, -3.3, 3.8),
    "Go": (20.1, 19.4, 21.0, -3.6, 20.2), "MySQL": (13.6, 13.0, 13.3, -4.1, 13.3), "AWS": (36.3, 34.3, 34.4, -5.3, 35.0),
    "TypeScript": (20.7, 19.5, 20.9, -5.7, 20.4), "Java": (36.9, 34.5, 32.1, -6.5, 34.5),
}
RISING = ["Linux", "FastAPI", "Redis", "Python", "LLM"]
FALLING = ["Java", "TypeScript", "AWS"]
TOP = ["AWS", "Java", "Git", "Python", "React", "CI/CD", "TypeScript", "Go", "Spring", "Docker"]
JOB_COUNTS = {
    "백엔드": [443, 563, 474, 581, 515, 493, 537, 418, 429],
    "프론트엔드": [65, 91, 62, 72, 63, 74, 64, 45, 63],
    "AI_ML": [68, 97, 79, 92, 93, 98, 74, 74, 109],
    "DevOps": [64, 76, 74, 114, 92, 71, 72, 46, 67],
    "데이터": [39, 59, 52, 62, 51, 54, 60, 34, 49],
    "모바일": [25, 37, 20, 45, 29, 29, 28, 20, 31],
}
PEAKS = {"백엔드": "2025-10", "프론트엔드": "2025-08", "AI_ML": "2026-03", "DevOps": "2025-10", "데이터": "2025-10", "모바일": "2025-10"}
FIRST_LAST = {"백엔드": -3.2, "프론트엔드": -3.1, "AI_ML": 60.3, "DevOps": 4.7, "데이터": 25.6, "모바일": 24.0}
BIG_JOBS = {"AI_ML": (101, 9.6), "DevOps": (168, 15.9), "PM_기획": (32, 3.0), "QA": (12, 1.1), "기타": (33, 3.1), "데이터": (97, 9.2),
            "모바일": (42, 4.0), "백엔드": (467, 44.2), "보안": (63, 6.0), "풀스택": (3, 0.3), "프론트엔드": (39, 3.7)}
SMALL_JOBS = {"AI_ML": (973, 11.3), "DevOps": (612, 7.1), "PM_기획": (87, 1.0), "QA": (93, 1.1), "기타": (505, 5.8), "데이터": (509, 5.9),
              "모바일": (322, 3.7), "백엔드": (4411, 51.1), "보안": (173, 2.0), "풀스택": (182, 2.1), "프론트엔드": (772, 8.9)}
