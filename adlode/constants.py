"""Fixed values the results depend on. Everything here can be overridden by a parameter."""

UNSPECIFIED = "Non précisé"
UNKNOWN = "unknown"
OTHER = "Other"

# City spellings, tested in this order.
CITY_MAP = {
    "douala": "Douala",
    "yaounde": "Yaoundé",
    "yaoundé": "Yaoundé",
    "yaounde cameroun": "Yaoundé",
    "douala cameroun": "Douala",
    "bafoussam": "Bafoussam",
    "bamenda": "Bamenda",
    "garoua": "Garoua",
    "maroua": "Maroua",
    "ngaoundere": "Ngaoundéré",
    "ngaoundéré": "Ngaoundéré",
    "ebolowa": "Ebolowa",
    "bertoua": "Bertoua",
    "limbe": "Limbé",
    "limbé": "Limbé",
    "kribi": "Kribi",
    "cameroon": "Cameroun",
    "cameroun": "Cameroun",
}

# Experience buckets with the fragments that select them, tested in this order.
EXPERIENCE_BUCKETS = (
    ("Junior (0–1 an)", ("junior", "débutant", "0-1", "moins d'1", "< 1", "entry")),
    ("1–2 ans", ("1 an", "1-2", "1 à 2", "entre 1")),
    ("2–5 ans", ("2 ans", "2-5", "2 à 5", "entre 2")),
    ("5+ ans", ("5 ans", "5-10", "5 à 10", "entre 5", "senior", "confirmé")),
    ("10+ ans", ("10 ans", "> 10", "10+")),
)

# Characters that make a neighbour part of the same word, for short aliases.
WORD_CHARS = "a-zàâäéèêëïîôöùûüç\u0300-\u036f0-9"

# Aliases up to this length need a word boundary on both sides; longer ones match anywhere.
SHORT_ALIAS = 3

# Aliases that only count when their context pattern occurs somewhere in the text.
CONTEXT_GUARDS = {
    "r": (
        r"(r\s+language|langage\s+r|programmation\s+r|r\s+programming|"
        r"rstudio|r\s+studio|tidyverse|ggplot2?|r\s+markdown|"
        r"r\s*[,/]\s*python|python\s*[,/]\s*r(?!\w)|"
        r"sas|spss|stata|statistical\s+computing|analyse\s+statistique)"
    ),
    "scala": (
        r"(scala\s+language|scala(?!\w)|"
        r"apache\s+spark|akka|play\s+framework|sbt|"
        r"functional\s+programming|programmation\s+fonctionnelle|"
        r"jvm|hadoop\s+scala|spark\s+scala)"
    ),
}

# Display names of portals; other portals keep their key.
PORTAL_LABELS = {
    "emploi_cm": "Emploi.cm",
    "talent_cm": "Talent.cm",
    "expertini_cm": "Expertini.cm",
    "workconnect": "WorkConnect",
}

# Words that start the job-type part of a location cell.
JOB_TYPES = ("Full-time", "Part-time", "Contract", "Temporary", "Internship")

# Phrases that mark a relative posting date, in order of preference.
DATE_PHRASES = ("Il y a", "il y a", "days ago", "Posted")

# Fragment of the label -> field, tested in this order.
LABEL_FIELDS = {
    "Compétences clés": "skills_raw",
    "Competences cles": "skills_raw",
    "Region de": "city",
    "Région de": "city",
    "Niveau d": "experience",
    "Niveau d’exp": "experience",
}

# Seeded demonstration rows carry this in their url.
DEMO_URL = "demo.example.com"

# Mining thresholds.
MIN_SUPPORT = 0.05
MIN_CONFIDENCE = 0.40
MIN_LIFT = 1.2
MAX_ITEMSET = 3
K_MIN = 3
K_MAX = 8
KMEANS_SEED = 42
KMEANS_MAX_ITER = 300  # steps a fit may take before it is cut off
FINAL_RESTARTS = 10
ELBOW_RESTARTS = 5
PROFILE_SKILLS = 10
PROFILE_WEIGHT = 0.05
MAX_PAGES = 10

# Archetypes with their keywords; on equal scores the earlier one wins.
ARCHETYPE_RULES = (
    ("Mobile Developer",
     ("Android", "iOS", "Flutter", "React Native", "Kotlin", "Swift", "Ionic")),
    ("Data Scientist / ML",
     ("Machine Learning", "TensorFlow", "PyTorch", "Scikit-learn", "NLP", "Deep Learning", "Computer Vision")),
    ("Data Analyst",
     ("Power BI", "Tableau", "Data Analysis", "Pandas", "Big Data", "R", "SAS")),
    ("DevOps / Cloud Engineer",
     ("Docker", "Kubernetes", "AWS", "Azure", "GCP", "CI/CD", "Terraform", "Ansible", "Cloud Computing")),
    ("Security Engineer",
     ("Cybersecurity", "VPN", "Active Directory", "Firewall")),
    ("Systems Administrator",
     ("Linux", "Networking", "Bash", "Nginx", "Apache", "TCP/IP", "Monitoring", "Virtualisation",
      "Active Directory")),
    ("IT Support / Sysadmin",
     ("Support Technique", "Networking", "TCP/IP", "Monitoring", "Active Directory", "VPN")),
    ("Backend Developer",
     ("Django", "Flask", "Spring", "Laravel", "Node.js", "FastAPI", "NestJS", "Express.js", "API")),
    ("Frontend Developer",
     ("React", "Vue.js", "Angular", "HTML", "CSS", "Next.js", "Bootstrap", "jQuery")),
    ("Full-Stack Developer",
     ("JavaScript", "TypeScript", "SQL", "REST API", "Git", "PHP")),
    ("Enterprise/ERP Consultant",
     ("SAP/ERP", "CRM", "DB2", "Oracle", "COBOL")),
)

# A single one of these skills is enough for its archetype.
SPECIFIC_SINGLES = {
    "Machine Learning": "Data Scientist / ML",
    "Kubernetes": "DevOps / Cloud Engineer",
    "Flutter": "Mobile Developer",
    "React Native": "Mobile Developer",
    "Cybersecurity": "Security Engineer",
    "Power BI": "Data Analyst",
    "Tableau": "Data Analyst",
}
DEFAULT_ARCHETYPE = "General IT"

# Skill groups of the report.
SKILL_GROUPS = {
    "Programming Languages": (
        "Java", "JavaScript", "Python", "SQL", "TypeScript", "PHP", "C#", "Ruby", "Go", "R", "Scala"),
    "Frameworks/Libraries": (
        "React", "Node.js", "Django", "Laravel", "Spring", "Angular", "Vue.js", "Flask", "Express"),
    "Databases": ("MySQL", "PostgreSQL", "MongoDB", "Oracle", "Redis", "SQL Server"),
    "DevOps/Cloud": ("Docker", "Kubernetes", "CI/CD", "AWS", "Azure", "Git", "Jenkins", "Terraform"),
    "Soft Skills/Methodologies": ("Agile", "Scrum", "Communication", "Leadership", "Team Management"),
}

# Common function words per language, used to tell languages apart.
LANGUAGE_WORDS = {
    "de": ("der", "die", "das", "und", "nicht", "mit", "auf", "den", "dem", "ist", "ein", "eine",
           "sich", "von", "für", "als", "auch", "des", "im", "zu"),
    "en": ("the", "and", "of", "to", "in", "that", "is", "for", "with", "on", "are", "was", "at",
           "be", "this", "from", "or", "by", "an", "as"),
    "es": ("el", "los", "las", "de", "que", "y", "en", "una", "por", "con", "para", "del", "es",
           "se", "no", "lo", "como", "más", "la", "su"),
    "fr": ("le", "la", "les", "des", "de", "et", "que", "pour", "un", "une", "dans", "est", "pas",
           "sur", "avec", "du", "au", "aux", "qui", "en"),
}
LANGUAGE_MIN_CHARS = 20
LANGUAGE_SCAN_CHARS = 500
