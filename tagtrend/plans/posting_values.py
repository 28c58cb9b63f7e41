"""Vocabulary of the job-posting pipeline.

Fixed values: results only match when these words, rules, periods, templates and formats are exactly as
they stand here. They are parameters of the operators and can be replaced by a caller's own.
"""

from __future__ import annotations

# Source labels, in order of precedence.
SOURCE_A, SOURCE_B, SOURCE_C = "원티드", "사람인", "잡다임"
UNKNOWN_STATUS = "unknown"

KEYWORDS = {
    "언어": [
        "Python", "Java", "JavaScript", "TypeScript", "Kotlin", "Swift", "Go", "Golang", "Rust", "C++", "C#", "Ruby",
        "Scala", "PHP", "R언어", "MATLAB",
    ],
    "프레임워크": [
        "Spring", "Spring Boot", "Django", "FastAPI", "Flask", "NestJS", "Express", "React", "Vue", "Angular", "Next.js",
        "Nuxt", "Flutter", "React Native", "PyTorch", "TensorFlow", "Keras", "Pandas", "Scikit-learn", "LangChain",
    ],
    "인프라": [
        "AWS", "GCP", "Azure", "Docker", "Kubernetes", "K8s", "Terraform", "Jenkins", "GitHub Actions", "CI/CD", "Linux",
        "Nginx", "Ansible",
    ],
    "데이터베이스": [
        "MySQL", "PostgreSQL", "MongoDB", "Redis", "Elasticsearch", "Oracle", "MariaDB", "DynamoDB", "Cassandra",
        "SQLite", "Kafka", "RabbitMQ", "Airflow",
    ],
    "AI_ML": [
        "LLM", "RAG", "GPT", "BERT", "Transformer", "딥러닝", "머신러닝", "자연어처리", "NLP", "컴퓨터비전",
        "Computer Vision", "MLOps", "Fine-tuning", "Embedding", "Vector DB", "FAISS", "ChromaDB",
    ],
    "협업": [
        "Git", "GitHub", "GitLab", "Jira", "Confluence", "Agile", "Scrum", "REST API", "GraphQL", "gRPC", "MSA",
        "마이크로서비스",
    ],
}

JOB_RULES = {
    "백엔드": ["백엔드", "Backend", "back-end", "Spring", "Django", "FastAPI", "Node", "API", "서버 개발", "서버개발"],
    "프론트엔드": ["프론트엔드", "Frontend", "front-end", "React", "Vue", "Angular", "Next", "UI개발", "UI 개발", "웹 퍼블"],
    "풀스택": ["풀스택", "Fullstack", "Full-stack", "풀 스택"],
    "모바일": ["iOS", "Android", "안드로이드", "모바일", "Flutter", "React Native"],
    "데이터": [
        "데이터 엔지니어", "데이터엔지니어", "Data Engineer", "데이터 분석", "Data Analyst", "데이터 사이언티스트",
        "Data Scientist", "Airflow", "ETL",
    ],
    "AI_ML": [
        "머신러닝", "딥러닝", "AI", "ML Engineer", "MLOps", "LLM", "인공지능", "NLP", "Computer Vision", "모델링",
    ],
    "DevOps": ["DevOps", "SRE", "Platform", "인프라", "Infrastructure", "Kubernetes", "Docker", "CI/CD", "클라우드"],
    "보안": ["보안", "Security", "정보보호", "취약점", "침해"],
    "QA": ["QA", "Quality", "테스트", "Test Engineer"],
    "PM_기획": ["PM", "Product Manager", "PO", "기획", "프로덕트"],
}
OTHER_JOB = "기타"

BIG, PUBLIC, SMALL = "대기업", "공공기관", "스타트업/중소"
SIZE_RULES = {
    BIG: [
        "삼성", "LG", "SK", "현대", "롯데", "한화", "포스코", "GS", "CJ", "카카오", "네이버", "라인", "쿠팡",
        "배달의민족", "토스", "당근", "넥슨", "NC소프트", "크래프톤", "펄어비스", "하나금융", "신한", "KB", "우리은행",
        "IBK", "코웨이", "KT", "SKT", "LGU+",
    ],
    PUBLIC: ["공사", "공단", "진흥원", "연구원", "기관", "국가", "한국전력", "ETRI"],
}

ESTIMATE_RANGE = ("2020-01-01", "2028-01-01")
LEAD_DAYS = 30
EDA_MONTHS = ("2025-06", "2026-03")
TREND_MONTHS = ("2025-07", "2026-03")
PERIODS = {"first": ("2025-07", "2025-09"), "second": ("2025-10", "2025-12"), "recent_from": "2026-01"}
TREND_KEYWORDS = [
    "Python", "Java", "AWS", "React", "Spring", "Docker", "TypeScript", "Kubernetes", "MySQL", "Git", "LLM", "Go",
    "PostgreSQL", "Redis", "Kotlin", "FastAPI", "NestJS", "GCP", "CI/CD", "Linux",
]
TREND_JOBS = ["백엔드", "프론트엔드", "AI_ML", "DevOps", "데이터", "모바일"]
CLUSTER_KEYWORDS = [
    "Python", "Java", "AWS", "React", "Spring", "Docker", "TypeScript", "Kubernetes", "MySQL", "Git", "LLM", "Go",
]
K_RANGE = (5, 7, 8, 9, 10, 12, 15)

DOCUMENT_LABELS = ["공고제목", "회사", "지역", "직무", "기술스택", "주요업무", "자격요건", "우대사항"]

TOPIC_RULES = {
    "백엔드": ["백엔드", "backend", "서버"],
    "프론트엔드": ["프론트엔드", "frontend", "프론트", "ui"],
    "AI_ML": ["ai", "인공지능", "머신러닝", "딥러닝", "ml", "llm"],
    "DevOps": ["devops", "sre", "인프라", "클라우드"],
    "데이터": ["데이터", "data"],
    "모바일": ["ios", "android", "모바일", "앱"],
}
INTENT_RULES = {
    "study": ["공부", "배워", "기술", "스택", "필요", "준비"],
    "timing": ["언제", "시기", "시즌", "지원"],
    "trend": ["트렌드", "뜨는", "핫", "요즘", "최신"],
    "size": ["대기업", "스타트업", "규모", "차이"],
}
TOPIC_CLUSTERS = [
    ("백엔드", 0), ("백엔드", 3), ("프론트엔드", 1), ("AI_ML", 4), ("DevOps", 2), ("DevOps", 8), ("데이터", 7), ("모바일", 5),
]

# Answer sections. Figures are derived from the analysed postings and filled in.
ANSWER_FORMATS = {
    "keyword_rate": "{keyword}({rate}%)",
    "study": "## {topic} 개발자 필수 기술스택\n\n**핵심 기술** (채용공고 기준 비율):\n{core}\n\n**추가 우대**:\n{plus}\n",
    "clusters": "\n## 세부 유형\n\n{lines}",
    "cluster": "**[유형 {number}] {name}** ({n}개 공고)\n- 핵심 기술: {tokens}\n- 특징: {size}\n",
    "timing": (
        "\n## 최적 지원 시기\n\n**{topic}** 채용 데이터:\n- 피크 시즌: **{peak}** ({n}개 공고, 월평균 {mean}개 대비 **{uplift}**)\n"
        "- 준비 시작 권장: **{prep}부터**"
    ),
    "timing_line": "- **{topic}**: {peak} 피크 ({n}개, {uplift}) → {prep}부터 준비",
    "timing_all": "\n## 최적 지원 시기\n\n직무별 채용 피크 시즌 (월평균 대비 증가율):\n{lines}",
    "rising_line": "- **{keyword}**: {first}개→{second}개 공고 ({growth})",
    "falling_line": "- **{keyword}**: {growth}",
    "rising": "\n**지금 급상승 중인 기술**:\n{lines}",
    "trend": "\n## 기술 트렌드\n\n**급상승 기술:**\n{rising}\n\n**비중 감소 (여전히 중요):**\n{falling}",
    "size": "\n## 회사 규모별 기술 스택 차이\n\n**{a}**: {a_list}\n**{b}**: {b_list}",
    "sample": "\n**{i}. {title}** - {company}",
    "sample_tags": "\n   기술: {tags}",
    "samples": "\n---\n**관련 채용공고 샘플:**\n{lines}",
    "overview": "## IT 채용 시장 핵심 정보\n\n**기술 Top 5**: {top}\n\n어떤 직무를 준비 중인지 알려주시면 더 구체적으로 안내해드릴게요!",
}
ANSWER_FOOTER = "\n\n---\n*데이터 출처: 채용공고 분석*"

CHAT_MARKERS = {
    "begin": "<|begin_of_text|>",
    "header_start": "<|start_header_id|>",
    "header_end": "<|end_header_id|>\n\n",
    "turn_end": "<|eot_id|>\n",
    "end": "<|end_of_text|>",
}
SPLIT_SEED, EVAL_SHARE, MAX_WORDS = 42, 0.1, 1024

SYSTEM_PROMPT = (
    "당신은 IT 채용 시장 데이터를 기반으로 개발자 학습 로드맵을 제시하는 전문 어시스턴트입니다. "
    "실제 채용공고 {n}개를 분석한 데이터를 바탕으로 구체적이고 실용적인 조언을 제공합니다."
)
PLAN_TEMPLATES = {
    "백엔드": [
        ("프로그래밍 기초", ["Python 또는 Java", "자료구조/알고리즘", "Git"]),
        ("웹 프레임워크", ["Spring Boot (Java)", "FastAPI/Django (Python)"]),
        ("데이터베이스", ["MySQL", "PostgreSQL", "Redis"]),
        ("인프라/클라우드", ["Docker", "AWS 기초", "CI/CD"]),
        ("심화", ["Kubernetes", "마이크로서비스", "시스템 설계"]),
    ],
    "프론트엔드": [
        ("웹 기초", ["HTML/CSS", "JavaScript ES6+", "Git"]),
        ("React 생태계", ["React", "TypeScript", "상태관리(Zustand/Redux)"]),
        ("빌드/툴링", ["Webpack/Vite", "npm/yarn", "ESLint"]),
        ("성능 최적화", ["Next.js (SSR/SSG)", "Web Vitals", "번들 최적화"]),
        ("심화", ["테스트(Jest/Cypress)", "디자인 시스템", "접근성"]),
    ],
    "AI_ML": [
        ("Python/수학 기초", ["Python", "NumPy/Pandas", "선형대수/통계"]),
        ("ML 기초", ["Scikit-learn", "데이터 전처리", "모델 평가"]),
        ("딥러닝", ["PyTorch", "신경망 아키텍처", "GPU 활용"]),
        ("LLM/생성형 AI", ["Hugging Face", "Fine-tuning", "RAG", "LangChain"]),
        ("MLOps", ["MLflow", "Docker", "Kubeflow", "AWS SageMaker"]),
    ],
    "DevOps": [
        ("Linux/네트워크 기초", ["Linux 명령어", "TCP/IP", "Shell Script"]),
        ("컨테이너", ["Docker", "Docker Compose"]),
        ("CI/CD", ["GitHub Actions", "Jenkins", "ArgoCD"]),
        ("클라우드", ["AWS (EC2/EKS/RDS)", "Terraform"]),
        ("오케스트레이션", ["Kubernetes", "모니터링(Prometheus/Grafana)"]),
    ],
    "풀스택": [
        ("기초", ["JavaScript/TypeScript", "HTML/CSS", "Git"]),
        ("프론트엔드", ["React", "Next.js", "상태관리"]),
        ("백엔드", ["Node.js/Express 또는 FastAPI", "REST API", "인증"]),
        ("데이터베이스/인프라", ["PostgreSQL", "Redis", "Docker", "배포"]),
        ("심화", ["시스템 설계", "성능 최적화", "테스트"]),
    ],
}
DEFAULT_PLAN = "백엔드"
PLAN_WEEKS = {"3개월": 12, "6개월": 24, "1년": 48}
DEFAULT_WEEKS = 24
PLAN_RESOURCES = {
    "Python": ["점프 투 파이썬 (무료 온라인)", "Python 공식 문서"],
    "Java": ["점프 투 자바", "백기선 Java 강의"],
    "Spring Boot": ["스프링 공식 가이드", "인프런 스프링부트 강의"],
    "React": ["React 공식 문서 (react.dev)", "모던 리액트 딥다이브"],
    "Docker": ["Docker 공식 Docs", "subicura 블로그 Docker 입문"],
    "AWS": ["AWS 무료 티어 실습", "AWS 공식 Getting Started"],
    "MySQL": ["MySQL 공식 문서", "생활코딩 MySQL"],
    "TypeScript": ["TypeScript 공식 핸드북", "타입스크립트 교과서"],
    "PyTorch": ["PyTorch 공식 튜토리얼", "딥러닝 with PyTorch (한빛)"],
    "Kubernetes": ["Kubernetes 공식 Docs", "CNCF 한국어 자료"],
}
DEFAULT_RESOURCE = "공식 문서 정독"
PLAN_TEXTS = {
    "title": "{job} 개발자 {period} 로드맵 ({company} 목표)",
    "summary": "{company} {job} 개발자 취업을 위한 {period} 학습 커리큘럼",
    "duration": "{weeks}주",
    "description": "{title} 단계에서는 {techs}을 집중 학습합니다.",
    "milestone": "{tech} 기반 미니 프로젝트 1개 완성",
    "portfolio_tip": "각 단계 완료 시 GitHub에 커밋 기록을 남기고, README에 기술 선택 이유와 트러블슈팅 경험을 상세히 작성하세요.",
}
PLAN_INSIGHTS = {"스타트업": "스타트업은 즉시 투입 가능한 실무 경험과 빠른 배포 능력을 중시합니다."}
PLAN_DEFAULT_INSIGHT = "대기업은 CS 기초, 코딩테스트, 체계적 아키텍처 설계 능력을 중시합니다."
STEP_PATTERN = "{step}단계 [{title}] — {techs} ({duration})"

PROFILE_DEFAULTS = {
    "job": ("job", "백엔드"), "company": ("company", "스타트업"), "experience": ("experience", "비전공자"),
    "period": ("goal_period", "6개월"),
}
NO_STACK = "없음"
PROFILE_PROMPT = """저는 {experience} 배경을 가진 취업 준비생입니다.
목표: {company} {job} 개발자 취업 ({period} 내)
현재 알고 있는 기술: {stack}

위 정보를 바탕으로 저에게 맞는 단계별 학습 로드맵을 JSON 형식으로 출력해주세요.

반드시 아래 JSON 형식만 출력하세요 (다른 텍스트 없이):
{
  "title": "로드맵 제목",
  "summary": "한 줄 요약",
  "total_weeks": 숫자,
  "steps": [
    {
      "step": 1,
      "title": "단계 제목",
      "duration": "2주",
      "techs": ["기술1", "기술2"],
      "description": "이 단계에서 할 일 설명",
      "resources": ["추천 학습 자료1", "자료2"],
      "milestone": "완료 기준"
    }
  ],
  "portfolio_tip": "포트폴리오 조언",
  "market_insight": "시장 데이터 기반 인사이트"
}"""
PLAN_SCHEMA = (
    "title string, summary string, total_weeks int, steps array<struct<step int, title string, duration string, "
    "techs array<string>, description string, resources array<string>, milestone string>>, portfolio_tip string, "
    "market_insight string"
)

# Samples of kind A: job x segment x question.
SAMPLE_SEGMENTS = [
    ("백엔드", SMALL, "스타트업"), ("백엔드", BIG, "대기업"), ("프론트엔드", SMALL, "스타트업"), ("프론트엔드", BIG, "대기업"),
    ("AI_ML", SMALL, "AI 스타트업"), ("AI_ML", BIG, "대기업"), ("DevOps", SMALL, "스타트업"), ("DevOps", BIG, "대기업"),
    ("풀스택", SMALL, "스타트업"), ("풀스택", BIG, "대기업"),
]
ROADMAP_QUESTIONS = [
    "{job} 개발자로 {company}에 취업하려면 어떤 순서로 공부해야 하나요?",
    "{company} {job} 포지션 준비를 위한 단계별 학습 로드맵을 알려주세요.",
    "취업 준비생인데 {job} 분야 {company} 취업을 목표로 하고 있어요. 로드맵 추천해 주세요.",
    "{job} 개발자 {company} 취업 준비, 어디서부터 시작해야 하나요?",
    "비전공자인데 {job} 개발자로 {company}에 취업할 수 있을까요? 공부 순서 알려주세요.",
    "{company} {job} 신입 공채 준비 중인데 1년 안에 가능한 로드맵 있을까요?",
    "현재 {job} 공부 중인데 {company} 취업을 위해 핵심만 뽑으면 뭘 먼저 해야 하나요?",
    "{job} 분야로 이직을 고려 중이에요. {company} 기준으로 필수 기술이 뭔가요?",
    "{company}에서 {job} 개발자로 일하려면 어떤 기술 스택을 알아야 하나요?",
    "{job} 개발자 취업 준비를 6개월 안에 끝내야 한다면 {company} 기준으로 어떻게 할까요?",
]
ROADMAP_HEAD = "**{job} 개발자 학습 로드맵** ({company} 취업 목표)\n"
ROADMAP_STEP = "📌 {step}단계 — {title}\n   필수 기술: {techs}\n"
ROADMAP_TIP = "💡 팁: 단계별로 프로젝트를 완성하며 GitHub에 포트폴리오를 쌓으세요. 각 단계는 2~4주를 권장합니다."
ROADMAP_TOP5 = "\n\n📊 채용 시장 데이터 (원티드 {n}개 공고 분석):\n   {size} TOP5 기술: {top5}"
NO_DATA = "데이터 없음"

# Samples of kind B: segment x question.
CHOICE_QUESTIONS = [
    "{size}에 취업하고 싶은데, 어떤 언어와 프레임워크를 먼저 배워야 할까요?",
    "{size} 개발자 채용 시장에서 가장 많이 요구하는 기술이 뭔가요?",
    "{size} 취업을 위해 기술 스택을 선택해야 하는데 뭘 골라야 할까요?",
    "요즘 {size} 채용공고에서 자주 보이는 기술 스택이 뭔지 알 수 있을까요?",
    "{size} 신입 개발자 공고에서 공통적으로 요구하는 기술은 무엇인가요?",
]
CHOICE_ANSWER = """채용공고 분석 결과, **{size_key}**에서 가장 많이 요구되는 기술입니다.

📌 **프로그래밍 언어** (공고 내 등장 비율)
   {languages}

📌 **프레임워크/라이브러리** (등장 비율)
   {frameworks}

✅ 추천 학습 순서:
   1. {language} 언어 기초 숙달 (문법 + 자료구조)
   2. {framework} 프레임워크로 실습 프로젝트 1개 완성
   3. Docker + CI/CD 기본 배포 경험
   4. AWS 기초 (EC2, S3, RDS) 실습

💡 {size}은 {focus}을 중시합니다."""
CHOICE_FOCUS = {SMALL: "즉시 투입 가능한 실무 능력", BIG: "CS 기초 + 코딩테스트 역량"}
SIZE_DISPLAY = {SMALL: "스타트업", BIG: "대기업"}

# Samples of kind C: comparison questions.
COMPARE_QUESTIONS = [
    "스타트업과 대기업의 기술 요구사항 차이가 궁금해요.",
    "{job} 개발자인데 스타트업이랑 대기업 중 어디를 먼저 목표로 해야 할까요?",
    "스타트업 개발자와 대기업 개발자가 사용하는 기술 스택이 많이 다른가요?",
    "취업 목표를 스타트업으로 할지 대기업으로 할지 모르겠어요. 기술 준비 방향이 다른가요?",
    "대기업 공고랑 스타트업 공고를 비교해봤는데 요구사항이 많이 달라요. 어떻게 준비해야 하죠?",
    "스타트업 경력으로 대기업으로 이직할 때 추가로 준비해야 할 기술이 있나요?",
]
COMPARE_JOBS = ["백엔드", "프론트엔드", "AI_ML", "DevOps", "풀스택", "백엔드"]
COMPARE_ANSWER = """채용공고 데이터 분석 결과입니다.

🚀 **스타트업/중소기업** 특화 기술 (대기업 대비)
   {small_list}
   풀스택 비율: {small_share}% — 한 사람이 넓은 범위 담당

🏢 **대기업** 특화 기술 (스타트업 대비)
   {big_list}
   풀스택 비율: {big_share}% — 역할 분업 명확, 전문성 심화 요구

✅ **준비 전략 차이**:
   스타트업 → 다양한 스택 경험 + 빠른 프로토타이핑 능력
   대기업   → 특정 스택 깊이 + CS 기초 + 코딩테스트 필수"""
COMPARE_NONE = "데이터 수집 중"
FULLSTACK = "풀스택"

# Samples of kind D: one per valid posting, rotating over the questions.
POSTING_QUESTIONS = [
    "다음은 {size} {job} 채용공고 자격요건입니다.\n\n[자격요건]\n{req}\n\n이 포지션 합격을 위한 준비 전략을 알려주세요.",
    "아래 {size} {job} 공고를 보고 있는데, 어떤 기술부터 준비해야 할지 모르겠어요.\n\n[자격요건]\n{req}",
    "{size} {job} 포지션에 지원하려고 합니다. 자격요건을 분석해서 학습 우선순위를 알려주세요.\n\n[자격요건]\n{req}",
    "이 {size} {job} 공고에 6개월 안에 합격하려면 뭘 먼저 해야 할까요?\n\n[자격요건]\n{req}",
]
POSTING_ANSWER = """이 **{size} {job}** 포지션 분석 결과입니다.

📌 핵심 요구 기술: {techs}

✅ 우선순위별 학습 전략:
{lines}

📂 포트폴리오 구성 팁:
   - 위 기술 스택을 활용한 미니 프로젝트 GitHub 업로드
   - README에 기술 선택 이유와 트러블슈팅 경험 명시

💡 {size} 지원 포인트: {tip}"""
POSTING_LINE = "   {i}. **{item}** — 공식 문서 + 실습 프로젝트 1개 완성"
POSTING_TIP = {
    SMALL: "즉시 투입 가능한 실무 경험과 포트폴리오를 강조하세요.",
    BIG: "코딩테스트 대비, CS 기초(OS·네트워크·DB), 팀 협업 경험이 중요합니다.",
}

# Samples of kind E: one per raw record, rotating over the questions.
RECORD_QUESTIONS = [
    "원티드에 올라온 '{title}' 포지션에 지원하려면 어떤 준비를 해야 할까요?",
    "'{title}' 직무의 주요 업무를 보고 싶어요. 이 포지션에 필요한 핵심 역량이 뭔가요?",
    "다음 채용공고 주요업무를 분석해서 취업 준비 방향을 알려주세요.\n\n[주요업무]\n{duties}",
    "'{title}' 공고를 보고 있는데, 자격요건에 나온 기술들을 어떻게 준비해야 하나요?\n\n[자격요건]\n{req}",
    "이런 업무를 하는 회사에 취업하고 싶어요. 필요한 기술 스택이 뭔가요?\n\n[주요업무]\n{duties}",
]
RECORD_ANSWER = """**{title}** 포지션 분석입니다.

📋 **주요 업무 요약**
{duties}

📌 **필수 자격요건**
{req}

{preferred}✅ **준비 가이드**
   1. 자격요건에 나온 기술 스택 우선 학습
   2. 주요업무와 유사한 미니 프로젝트 1~2개 제작
   3. 우대사항 기술은 여유 있을 때 추가 학습
   4. {region} 기반 회사이므로 현지 취업 네트워크도 활용하세요.

💡 **{search}** 분야 공고 기준으로, 해당 도메인의 오픈소스 기여나 개인 프로젝트가 있으면 강점이 됩니다."""
RECORD_PREFERRED = "⭐ **우대사항** (있으면 플러스)\n{preferred}\n\n"
RECORD_DEFAULTS = {"title": "개발자", "empty": "정보 없음", "region": "서울", "search": "개발"}
